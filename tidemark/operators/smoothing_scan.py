"""Exponential smoothing of series of any length, as a scan of affine maps.

Both recursions move a state (level, trend) by an affine map at every point, v -> M v + x c, with
one M and c for a whole series. Maps compose, and composition is associative: a stretch of
n points is itself one affine map. So points are cut into cells of time, each cell is folded
into its map, cells into stretches of `FAN` cells and so on; the few top stretches are composed in
order, and the states at their starts are carried back down, level by level, to the
points. A cell is the largest thing a task holds at once, whatever the length of the
series; all of it runs in expressions.

The first point of a series sets the state. With trend that takes the second point too, which
may lie in a later cell: it travels with the first points of the stretches.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

#: Cells or stretches that are folded together.
FAN = 128
LEVELS = 3
CELL_SECONDS = 24 * 60 * 60
STATE = "struct<level:double,trend:double>"


@dataclass(frozen=True)
class Smoother:
    """Simple smoothing, or smoothing with trend if `beta` is given."""

    alpha: float
    beta: float | None = None

    @property
    def matrix(self):
        """Rows of M; c is (alpha, 0) or (alpha, alpha * beta)."""
        a, b = self.alpha, self.beta
        return ((1 - a, 0.0), (0.0, 0.0)) if b is None else (
            (1 - a, 1 - a), (-a * b, 1 - a * b))

    @property
    def gain(self):
        return self.alpha, 0.0 if self.beta is None else self.alpha * self.beta


def _of_series(smoothers, metric, value):
    """A column that depends on the metric."""
    column = None
    for name, smoother in smoothers.items():
        literal = F.lit(value(smoother))
        column = (F.when(F.col(metric) == name, literal) if column is None
                  else column.when(F.col(metric) == name, literal))
    return column


def _state(level, trend):
    return F.struct(level.cast("double").alias("level"), trend.cast("double").alias("trend"))


def _moved(v, m, c, x):
    """M v + x c."""
    return _state(m["m11"] * v["level"] + m["m12"] * v["trend"] + c["c1"] * x,
                  m["m21"] * v["level"] + m["m22"] * v["trend"] + c["c2"] * x)


def _carried(v, map_):
    """The state behind a stretch, from the one before it."""
    return _state(map_["m11"] * v["level"] + map_["m12"] * v["trend"] + map_["b1"],
                  map_["m21"] * v["level"] + map_["m22"] * v["trend"] + map_["b2"])


def _composed(first, then):
    """The map of two stretches in a row."""
    def dot(i, j):
        return (then[f"m{i}1"] * first[f"m1{j}"] + then[f"m{i}2"] * first[f"m2{j}"])

    def moved(i):
        return then[f"m{i}1"] * first["b1"] + then[f"m{i}2"] * first["b2"] + then[f"b{i}"]
    return F.struct(*[dot(i, j).alias(f"m{i}{j}") for i in (1, 2) for j in (1, 2)],
                    *[moved(i).alias(f"b{i}") for i in (1, 2)])


def _still(zero=0.0):
    """The map that changes nothing."""
    values = {"m11": 1.0, "m12": 0.0, "m21": 0.0, "m22": 1.0, "b1": zero, "b2": zero}
    return F.struct(*[F.lit(value).alias(name) for name, value in values.items()])


def _rest(array, start):
    return F.slice(array, start, F.greatest(F.size(array) - (start - 1), F.lit(0)))


def _after_first(first, second):
    """The state behind the first point: its value and the step to the second."""
    return _state(first, F.when(F.col("with_trend"), second - first).otherwise(0.0))


def _cells(series, smoothers, key, time, cell_seconds):
    """One row per key and cell: its points in order, its map, its first two points and the state behind
    it if the series begins there (without a second point, that of the first alone)."""
    others = [c for c in series.columns if c not in key and c != time]
    points = F.array_sort(F.collect_list(F.struct(time, *others))).alias("points")
    cell = F.floor(F.unix_micros(time) / F.lit(cell_seconds * 1_000_000)).cast("bigint")
    cells = series.groupBy(*key, cell.alias("cell")).agg(points)
    m = {name: _of_series(smoothers, "metric", lambda s, i=i, j=j: s.matrix[i][j])
         for name, (i, j) in {"m11": (0, 0), "m12": (0, 1), "m21": (1, 0), "m22": (1, 1)}.items()}
    c = {f"c{i + 1}": _of_series(smoothers, "metric", lambda s, i=i: s.gain[i]) for i in (0, 1)}
    cells = cells.withColumns({
        "m": F.struct(*[column.alias(name) for name, column in m.items()]),
        "c": F.struct(*[column.alias(name) for name, column in c.items()]),
        "with_trend": _of_series(smoothers, "metric", lambda s: s.beta is not None)})
    step = F.struct(*[F.col("m")[x].alias(x) for x in m])

    def folded(map_, point):
        x = point["value"].cast("double")
        then = F.struct(*[step[name].alias(name) for name in m],
                        *[(F.col("c")[f"c{i}"] * x).alias(f"b{i}") for i in (1, 2)])
        return _composed(map_, then)

    def walked(state, point):
        return _moved(state, F.col("m"), F.col("c"), point["value"].cast("double"))

    first = F.get("points", F.lit(0))["value"].cast("double")
    second = F.get("points", F.lit(1))["value"].cast("double")
    return cells.withColumns({
        "map": F.aggregate("points", _still(), folded),
        "first": first, "second": second, "several": F.size("points") > 1,
        "begun": F.when(F.size("points") > 1, F.aggregate(
            _rest(F.col("points"), 2), _after_first(first, second), walked))})


def _entries(stretches):
    """The state before each of an ordered array of stretches: null before the first of a series.

    `entry` is the state before the first stretch, or null if the series begins with it. Of a
    series that begins, the first point's step to the second is known from the stretch itself or
    from the next one's first point.
    """
    begins = F.col("entry").isNull()
    first, next_ = F.get(stretches, F.lit(0)), F.get(stretches, F.lit(1))
    behind_first = F.when(begins, F.coalesce(first["begun"], _after_first(
        first["first"], F.coalesce(next_["first"], F.col("next_first"))))).otherwise(
        _carried(F.col("entry"), first["map"]))

    def follow(held, stretch):
        return F.struct(_carried(held["now"], stretch["map"]).alias("now"),
                        F.concat(held["states"], F.array(held["now"])).alias("states"))

    start = F.struct(behind_first.alias("now"),
                     F.array(F.col("entry")).cast(f"array<{STATE}>").alias("states"))
    return F.aggregate(_rest(stretches, 2), start, follow)["states"]


def _wider(level, key, fan):
    """Stretches of `fan` cells each, from those of the level below."""
    inner = F.struct("cell", "map", "first", "second", "several", "begun", "with_trend")
    rows = (level.groupBy(*key, F.floor(F.col("cell") / fan).cast("bigint").alias("wide"))
            .agg(F.array_sort(F.collect_list(inner), lambda a, b: F.when(
                a["cell"] < b["cell"], -1).when(a["cell"] > b["cell"], 1).otherwise(0)).alias("inner"),
                F.first("with_trend").alias("with_trend")))
    first, next_ = F.get("inner", F.lit(0)), F.get("inner", F.lit(1))
    second = F.when(first["several"], first["second"]).otherwise(next_["first"])
    several = first["several"] | (F.size("inner") > 1)
    behind_first = F.coalesce(first["begun"], F.when(F.size("inner") > 1, _after_first(
        first["first"], next_["first"])))
    begun = F.aggregate(_rest(F.col("inner"), 2), behind_first,
                        lambda state, stretch: _carried(state, stretch["map"]))
    return rows.select(
        *key, F.col("wide").alias("cell"), "inner", "with_trend",
        F.aggregate("inner", _still(), lambda map_, stretch: _composed(map_, stretch["map"])).alias("map"),
        first["first"].alias("first"), second.alias("second"), several.alias("several"),
        F.when(several, begun).alias("begun"))


def smooth_scan(series, smoothers, key=("metric",), time="time", cell_seconds=CELL_SECONDS,
                fan=FAN, levels=LEVELS):
    """Adds `smooth` to the points (metric, time, value, ...) of every series, as `smooth_series`.

    `smoothers` gives each metric its `Smoother`. A cell should hold some hundred points at most:
    a day for intervals of 15 minutes. Only the stretches of the top level, `fan ** (levels - 1)` cells
    wide, of one series meet in one task. A missing value makes all later smoothed values missing;
    a series of one point has that point. Times within a series are distinct.
    """
    key = list(key)
    cells = _cells(series, smoothers, key, time, cell_seconds)
    narrow = cells.select(*key, "cell", "map", "first", "second", "several", "begun", "with_trend")
    steps = [narrow]
    for _ in range(levels - 1):
        steps.append(_wider(steps[-1], key, fan))
    whole = (steps[-1].drop("inner") if levels > 1 else steps[-1])
    inner = F.struct("cell", "map", "first", "second", "several", "begun")
    top = whole.groupBy(*key).agg(
        F.array_sort(F.collect_list(inner), lambda a, b: F.when(
            a["cell"] < b["cell"], -1).when(a["cell"] > b["cell"], 1).otherwise(0)).alias("inner"),
        F.first("with_trend").alias("with_trend"))
    top = top.withColumns({"entry": F.lit(None).cast(STATE), "next_first": F.lit(None).cast("double")})
    entries = _spread(top, key)
    for level in range(levels - 1, 0, -1):
        held = steps[level].select(*key, "cell", "inner", "with_trend").join(entries, [*key, "cell"])
        entries = _spread(held, key)
    return _points(cells.join(entries, [*key, "cell"]), series, key, time)


def _spread(held, key):
    """`entry` and `next_first` of every inner stretch of some stretches."""
    after = F.concat(_rest(F.transform("inner", lambda s: s["first"]), 2),
                     F.array(F.col("next_first")))
    rows = held.select(*key, F.explode(F.arrays_zip(
        F.transform("inner", lambda s: s["cell"]).alias("cell"),
        _entries(F.col("inner")).alias("entry"), after.alias("next_first"))).alias("x"))
    return rows.select(*key, "x.cell", "x.entry", "x.next_first")


def _points(cells, series, key, time):
    """The points of all cells with their smoothed values."""
    value = F.col("first")
    begins = F.col("entry").isNull()
    second = F.coalesce("second", "next_first")

    def output(state):
        return state["level"] + F.when(F.col("with_trend"), state["trend"]).otherwise(0.0)

    def follow(held, point):
        state = _moved(held["now"], F.col("m"), F.col("c"), point["value"].cast("double"))
        return F.struct(state.alias("now"), F.concat(held["smooth"], F.array(output(state))).alias("smooth"))

    lone = F.struct(_after_first(value, second).alias("now"), F.array(value).alias("smooth"))
    state = _moved(F.col("entry"), F.col("m"), F.col("c"), value)
    start = F.when(begins, lone).otherwise(
        F.struct(state.alias("now"), F.array(output(state)).alias("smooth")))
    smooth = F.aggregate(_rest(F.col("points"), 2), start, follow)["smooth"]
    rows = cells.select(*key, F.explode(F.arrays_zip(F.col("points"), smooth.alias("smooth"))).alias("x"))
    return rows.select(*[F.col(c) if c in key else F.col(f"x.points.{c}") for c in series.columns],
                       "x.smooth")
