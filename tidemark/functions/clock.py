"""The as-of moment that replaces every wall-clock function."""

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import functions as F

INTERVAL_MINUTES = 15


def timestamp_literal(moment):
    """A timestamp column in the session time zone (not the driver's local one)."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def midnight(day):
    return datetime.combine(day, time())


@dataclass(frozen=True)
class AsOf:
    """`now()` of a run, fixed by the caller so that runs can be repeated."""

    moment: datetime

    @classmethod
    def of(cls, value):
        if isinstance(value, AsOf):
            return value
        if isinstance(value, str):
            value = datetime.fromisoformat(value)
        if value.tzinfo is not None:
            raise ValueError("give the moment in the session time zone, without an offset")
        return cls(value)

    @property
    def today(self) -> date:
        return self.moment.date()

    @property
    def yesterday(self) -> date:
        return self.today - timedelta(days=1)

    @property
    def report_week(self):
        """First and last day of the report: yesterday and the seven days before it."""
        return self.yesterday - timedelta(weeks=1), self.yesterday

    @property
    def open_interval(self) -> datetime:
        """Start of the 15-minute interval that is still filling up."""
        return self.moment.replace(
            minute=self.moment.minute - self.moment.minute % INTERVAL_MINUTES,
            second=0, microsecond=0)

    @property
    def live_start(self) -> datetime:
        """Earliest event time of the anomaly job.

        The source rule compares the midnight of the event's day with "a day
        ago", so a day counts only if its midnight lies within the last 24
        hours: today, or also yesterday when the run happens exactly at 00:00.
        """
        day_ago = self.moment - timedelta(days=1)
        first = midnight(day_ago.date())
        return first if first >= day_ago else first + timedelta(days=1)
