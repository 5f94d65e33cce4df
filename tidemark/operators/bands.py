"""IQR band around a smoothed series, and the anomaly flag.

Windows are partitioned by series; a series has one row per 15-minute interval.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import percent

BAND_ROWS = 10
# First and last row of the averaging frame around the current one.
FRAMES = {"centered": (-(BAND_ROWS // 2), BAND_ROWS - BAND_ROWS // 2 - 1),
          "trailing": (-(BAND_ROWS - 1), 0)}


def rolling(aggregate, column, frame, rows):
    """An aggregate over a row frame; NULL until the frame holds `rows` values."""
    return F.when(F.count(column).over(frame) == rows, aggregate(column).over(frame))


def add_band(smoothed, window=6, coef=2, band="trailing", key=("metric",), time="time"):
    """Rolling quartiles, deviation, band limits and the flag for every row.

    `band="centered"` averages the limits over the rows -5..+4 and so leaves the
    latest four rows without limits: their flag is NULL and the latest point can
    never alert. `band="trailing"` averages the last ten rows instead.
    """
    series = Window.partitionBy(*key).orderBy(time)
    recent = series.rowsBetween(-(window - 1), 0)
    averaged = series.rowsBetween(*FRAMES[band])

    def quantile(q):
        return rolling(lambda c: F.percentile(c, F.lit(q)), "smooth", recent, window)

    quartiles = smoothed.withColumns({"smooth_75": quantile(0.75), "smooth_25": quantile(0.25)})
    iqr = quartiles.withColumn("iqr", F.col("smooth_75") - F.col("smooth_25"))
    limits = iqr.withColumns({
        "deviation": percent(F.col("value") - F.col("smooth"), "smooth"),
        "raw_upper": F.col("smooth_75") + coef * F.col("iqr"),
        "raw_lower": F.col("smooth_25") - coef * F.col("iqr")})
    return (limits
            .withColumns({"smooth_upper": rolling(F.avg, "raw_upper", averaged, BAND_ROWS),
                          "smooth_lower": rolling(F.avg, "raw_lower", averaged, BAND_ROWS)})
            .drop("raw_upper", "raw_lower")
            .withColumn("is_alert", (F.col("value") > F.col("smooth_upper"))
                        | (F.col("value") < F.col("smooth_lower"))))


def latest_points(banded, key=("metric",), time="time"):
    """The last row of every series."""
    rest = F.struct(*[c for c in banded.columns if c not in key])
    return (banded.groupBy(*key).agg(F.max_by(rest, time).alias("last"))
            .select(*key, "last.*"))
