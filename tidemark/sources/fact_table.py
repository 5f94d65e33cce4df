"""The daily fact table: one Parquet directory per event date."""

from tidemark.sources.schemas import DAILY_ACTIVITY, conform


def create_daily_activity(spark, table, location=None):
    """Create the table unless it exists, with the fixed schema."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DAILY_ACTIVITY)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"PARTITIONED BY (event_date){place}")


def load_daily_activity(cube, table, day, append=False):
    """Load the cube of one day into the table.

    The default replaces that day's partition and no other, so a retried run
    does not count twice. `append=True` adds rows as a plain insert would. The
    cube holds a few rows: one output file is enough.
    """
    measures = [c for c in DAILY_ACTIVITY.names if c != "event_date"]
    rows = conform(cube, DAILY_ACTIVITY).select(*measures).repartition(1)
    cube.sparkSession.sql(
        f"INSERT {'INTO' if append else 'OVERWRITE'} {table} "
        f"PARTITION (event_date = DATE '{day}') SELECT * FROM {{rows}}", rows=rows)


def read_daily_activity(spark, table):
    return spark.table(table).select(*DAILY_ACTIVITY.names)
