"""Mixing sources to target weights by repeating documents.

Per source the words are counted and a target is set; the repetition rate is target over size. A document is emitted
floor(rate) times, and once more if a hash of its id falls below the fraction of the rate, so a rerun draws the same
copies and no task needs to know of another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.llm.columns import boxed, row_key, staged, unboxed, word_count

_STEPS = 1 << 52


def ranked(sources: DataFrame, source: str) -> DataFrame:
    """Distinct values numbered from 0 by code point, NULL last, as ``rank``.

    The values are range-partitioned and each partition numbers its own, so no task sees all values; the driver adds up
    one count per partition.
    """
    order = [F.col(source).asc_nulls_last()]
    parts = sources.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    local = staged(
        parts.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy(*order))), "mix-ranks", small=True
    )
    # one row per range partition
    counts = sorted((r["__part"], r["n"]) for r in local.groupBy("__part").agg(F.count("*").alias("n")).collect())
    before = [(part, sum(n for _, n in counts[:i])) for i, (part, _) in enumerate(counts)]
    before = local.sparkSession.createDataFrame(before, "__part int, __before bigint")
    return (
        local.join(before, "__part")
        .withColumn("rank", F.col("__before") + F.col("__row") - 1)
        .drop("__part", "__row", "__before")
    )


def fill_to_targets(sources: DataFrame, total_numerator: int, total_denominator: int, cap: int) -> DataFrame:
    """``sources`` (``size``, ``weight``) with ``target``: shares of the total by weight, none above ``cap`` sizes.

    What a capped source leaves over goes to the others by weight, again until none is above. Each round is one sum
    over the sources; a source that was capped stays capped, so the rounds end. Sums are whole numbers, hence exact.
    """
    capped = F.lit(False)
    while True:
        sums = sources.select("size", "weight", capped.alias("c")).agg(
            F.sum("size").alias("all"),
            F.sum(F.when(F.col("c"), F.col("size")).otherwise(0)).alias("held"),
            F.sum(F.when(F.col("c"), 0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(F.col("c").cast("int")).alias("n"),
        ).first()
        if sums["all"] is None or not sums["weights"]:
            return sources.withColumn("target", (F.col("size") * cap).cast("double"))
        # left over, in units of 1 / total_denominator
        left = total_numerator * sums["all"] - total_denominator * cap * sums["held"]
        share = F.col("weight").cast("decimal(38,0)") * F.lit(left).cast("decimal(38,0)")
        most = F.col("size").cast("decimal(38,0)") * F.lit(cap * total_denominator * sums["weights"]).cast("decimal(38,0)")
        above = capped | (share > most)
        now = sources.select(above.alias("c")).agg(F.sum(F.col("c").cast("int")).alias("n")).first()["n"]
        if now == sums["n"]:
            even = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(total_denominator * sums["weights"]))
            return sources.withColumn("target", F.when(capped, (F.col("size") * cap).cast("double")).otherwise(even))
        capped = above


def draw(seed: str, key: Column) -> Column:
    """A number in [0, 1) by hash: the first 52 bits of the MD5 of the seed and the key."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + "|"), key.cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(_STEPS))


def mixed(
    docs: DataFrame,
    sources: DataFrame,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size``, the columns of ``sources`` and ``copies``, how often the mix takes the document.

    ``sources`` has one row per source with ``source_size`` and ``target``. A document without an id is drawn by a hash
    of its text. Repeated rows draw alike, each for itself.
    """
    one = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), row_key(text, key).cast("string")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    added = ("source_size", "target", "copies")
    targets = sources.select(F.col(source).alias("of"), "source_size", "target")
    # one weight row per source: Spark broadcasts it only if its measured size is below the session's threshold
    return unboxed(
        boxed(docs, one=one, source=F.col(source))
        .join(targets, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", (whole + F.when(draw(seed, F.col("one")) < rate - whole, 1).otherwise(0)).cast("long")),
        *added,
        but=added,
    )


def emit(mix: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row of the mix as often as it is taken, with the number of the copy as ``copy``."""
    return mix.where(F.col(copies) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    total: tuple[int, int] = (3, 2),
    cap: int = 2,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken`` (words the mix takes).

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``total`` (a fraction) of all words; no
    source's target exceeds ``cap`` times its size. A NULL text has size 0. Sources without words have target 0. No
    rows give no rows. Columns of the same names are replaced.
    """
    added = ["size", "source_size", "target", "copies", "taken", "rank", "weight"]
    docs = docs.drop(*(c for c in added if c in docs.columns and c not in (source, text, key)))
    sized = docs.withColumn("size", word_count(F.col(text)))
    per_source = sized.select(F.col(source).alias("source"), "size").groupBy("source").agg(F.sum("size").alias("size"))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = staged(
        ranked(staged(per_source, "mix-sizes", small=True), "source").withColumn("weight", weight.cast("long")), "mix-weights", small=True
    )
    targets = fill_to_targets(weighed, total[0], total[1], cap).select(
        F.col("source").alias(source), F.col("size").alias("source_size"), "target"
    )
    return mixed(sized, targets, source, text, key, seed).withColumn("taken", F.col("size") * F.col("copies"))
