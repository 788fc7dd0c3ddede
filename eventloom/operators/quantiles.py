"""Exact quantiles without collecting a group in one task.

Finding the value at a place is a selection: cut the values into ranges, count each range, go on with the range that
holds the place. A sketch gives, for every group, two values that most likely enclose the wanted place; what lies below
and above collapses into counts, and only the enclosed distinct values, a small fraction of the group, are kept. While
these are too many for one row, they are cut into ranges again and the counts before each range tell which one to keep.
Nothing depends on the sketch being right: where the counts show that it missed, the values on that side are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.workspace import discard, stage

ACCURACY = 10_000
#: Distinct values that are put in order in one row; more are cut into ranges first.
SMALL = 50_000
RANGES = 64


def _bounds(rows: DataFrame, by: list[str], probabilities: dict[str, float], accuracy: int) -> DataFrame:
    """Per group the number of values, and an array with the name, wanted position (from zero) and enclosing values of
    each quantile."""
    margin = 3.0 / accuracy
    marks = [max(0.0, p - margin) for p in probabilities.values()] + [min(1.0, p + margin) for p in probabilities.values()]
    sketched = rows.groupBy(*by).agg(
        F.count("value").alias("n"), F.percentile_approx("value", marks, accuracy).alias("marks")
    )

    def target(i: int, name: str, probability: float) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            ((F.col("n") - 1) * F.lit(float(probability))).alias("position"),
            F.get("marks", F.lit(i)).alias("low"),
            F.get("marks", F.lit(i + len(probabilities))).alias("high"),
        )

    targets = [target(i, name, p) for i, (name, p) in enumerate(probabilities.items())]
    return sketched.where("n > 0").select(*by, "n", F.array(*targets).alias("targets"))


def _between(low: Column, high: Column, position: Column) -> Column:
    """Linear interpolation between the values at the two places around a position."""
    return F.when(low == high, low).otherwise(low + (position - F.floor(position)) * (high - low))


def _small_groups(rows: DataFrame, by: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Groups of a bounded number of values, each put in order in a row."""
    ordered = rows.groupBy(*by).agg(F.array_sort(F.collect_list("value")).alias("values")).where(F.size("values") > 0)

    def quantile(probability: float) -> Column:
        position = (F.size("values") - 1) * F.lit(float(probability))
        at = lambda place: F.get("values", place.cast("int"))
        return _between(at(F.floor(position)), at(F.ceil(position)), position)

    return ordered.select(*by, *[quantile(p).alias(name) for name, p in probabilities.items()])


def _sided(rows: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """Every value once per target of its group: ``key`` (group, name, position), ``value``, and ``side``, which is -1
    below the enclosing values, 1 above and 0 between them."""
    group = F.struct(*by, F.lit(0).alias("-")).alias("group")
    joined = rows.select(group, "value").join(bounds.select(group, "targets"), "group")
    side = F.when(F.col("value") < F.col("low"), -1).when(F.col("value") > F.col("high"), 1).otherwise(0)
    return joined.select("group", "value", F.inline("targets")).select(
        F.struct("group", "name", "position").alias("key"), "value", side.alias("side")
    )


def _in_range(candidates: DataFrame) -> DataFrame:
    """Of each key the values of the one range, out of ``RANGES``, that holds the wanted place."""
    grid = [k / RANGES for k in range(1, RANGES)]
    marks = candidates.groupBy("key").agg(F.percentile_approx("value", grid, ACCURACY).alias("marks"))
    numbered = candidates.join(marks, "key").withColumn(
        "range", F.size(F.filter("marks", lambda m: m < F.col("value")))
    ).drop("marks")
    sums = numbered.groupBy("key", "range").agg(F.sum("n").alias("n"), F.max("want").alias("want"))
    # at most RANGES entries for a key
    counts = sums.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("range", "n"))).alias("counts"), F.max("want").alias("want"))
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(-1).alias("range"))

    def step(state: Column, entry: Column) -> Column:
        past = state["before"] + entry["n"]
        found = (state["range"] >= 0) | (past > F.col("want"))
        number = F.when(state["range"] >= 0, state["range"]).when(past > F.col("want"), entry["range"]).otherwise(F.lit(-1))
        return F.struct(F.when(found, state["before"]).otherwise(past).alias("before"), number.alias("range"))

    chosen = counts.select(F.col("key").alias("of"), F.aggregate("counts", start, step).alias("chosen"))
    same = (F.col("key") == F.col("of")) & (F.col("range") == F.col("chosen.range"))
    return numbered.join(chosen, same).select("key", (F.col("want") - F.col("chosen.before")).alias("want"), "value", "n")


def _selected(candidates: DataFrame, small: int) -> DataFrame:
    """``key`` and the ``value`` at the wanted place among values that occur ``n`` times each."""
    candidates = stage(candidates, "quantile-values")
    while (candidates.groupBy("key").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0) > small:
        fewer = stage(_in_range(candidates), "quantile-values")
        discard(candidates)
        candidates = fewer
    ordered = candidates.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("value", "n"))).alias("all"), F.max("want").alias("want")
    )
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("double").alias("value"))

    def step(state: Column, entry: Column) -> Column:
        past = state["before"] + entry["n"]
        here = state["value"].isNull() & (past > F.col("want"))
        return F.struct(past.alias("before"), F.when(here, entry["value"]).otherwise(state["value"]).alias("value"))

    return ordered.select("key", F.aggregate("all", start, step, lambda state: state["value"]).alias("value"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    small: int = SMALL,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probabilities`` (name to probability).

    The sketches are made when this is called. ``df`` is read twice or thrice: stage it first when it is expensive to
    compute. NULL values are ignored; a group without any other has no row.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("value")).where(F.col("value").isNotNull())
    bounds = stage(_bounds(rows, by, probabilities, accuracy), "quantile-bounds")
    if (bounds.agg(F.max("n")).first()[0] or 0) <= small:
        return _small_groups(rows, by, probabilities)
    counted = stage(
        _sided(rows, bounds, by)
        .withColumn("each", F.when(F.col("side") == 0, F.col("value")))
        .groupBy("key", "side", "each")
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("largest"), F.min("value").alias("smallest")),
        "quantile-counts",
    )
    on = lambda side, column: F.when(F.col("side") == side, F.col(column))
    ends = counted.groupBy("key").agg(
        F.coalesce(F.sum(on(-1, "n")), F.lit(0)).alias("below"), F.coalesce(F.sum(on(0, "n")), F.lit(0)).alias("inside"),
        F.max(on(-1, "largest")).alias("last_below"), F.min(on(1, "smallest")).alias("first_above"),
    )
    place, upto = F.col("place"), F.col("below") + F.col("inside")
    places = F.explode(F.array_distinct(F.array(F.floor("key.position"), F.ceil("key.position")))).alias("place")
    known = F.when(place == F.col("below") - 1, F.col("last_below")).when(place == upto, F.col("first_above"))
    wanted = stage(
        ends.select("*", places).select(
            "key", "place", known.alias("value"),
            F.when(place < F.col("below"), -1).when(place >= upto, 1).otherwise(0).alias("on"),
            (place - F.when(place < F.col("below"), 0).when(place >= upto, upto).otherwise(F.col("below"))).alias("want"),
        ),
        "quantile-places",
    )
    open_places = wanted.where("value IS NULL").select(F.struct("key", "place").alias("one"), F.col("key").alias("of"), "on", "want")
    values = counted.where("side = 0").select("key", "side", F.col("each").alias("value"), "n")
    if not open_places.where("on <> 0").isEmpty():
        missed = _sided(rows, bounds, by).where("side <> 0").groupBy("key", "side", "value").agg(F.count(F.lit(1)).alias("n"))
        values = values.unionByName(missed)
    candidates = values.join(open_places, (F.col("key") == F.col("of")) & (F.col("side") == F.col("on"))).select(
        F.col("one").alias("key"), "want", "value", "n"
    )
    found = _selected(candidates, small).select("key.key", "key.place", "value")
    found = found.unionByName(wanted.where("value IS NOT NULL").select("key", "place", "value"))
    at = lambda f: F.max(F.when(F.col("place") == f("key.position"), F.col("value")))
    picked = found.groupBy("key").agg(at(F.floor).alias("low"), at(F.ceil).alias("high"))
    quantile = _between(F.col("low"), F.col("high"), F.col("key.position"))
    per_name = [F.max(F.when(F.col("key.name") == name, quantile)).alias(name) for name in probabilities]
    return picked.groupBy("key.group").agg(*per_name).select(*[F.col(f"group.`{c}`").alias(c) for c in by], *probabilities)
