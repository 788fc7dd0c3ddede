"""Boilerplate lines: lines that too large a share of a site's pages contain.

Per site, the pages that contain a line are divided by all pages of the site. A line over the ratio is dropped from
every page of that site and stays everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.llm.columns import SPACES, boxed, column, staged, unboxed


def _key(line: Column) -> Column:
    """96 bits for a line, without the white space around it."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def boilerplate(
    docs: DataFrame, site: str, lines: Column, ratio: float, min_pages: int, page: Column | None = None
) -> DataFrame:
    """Per site the keys of its boilerplate lines, as ``__site`` and ``__keys``.

    A page counts a line once; rows of a site that agree in ``page`` are one page. A site has at most (mean distinct
    lines of a page) / ratio such lines, so the array is bounded whatever the number of pages.
    """
    of = [F.col(site).alias("__site")] + ([] if page is None else [page.alias("__page")])
    pages = docs.select(*of, F.array_distinct(F.transform(lines, _bare)).alias("__lines"))
    each = pages.drop("__lines")
    on = (
        pages.select(*each.columns, F.explode("__lines").alias("__line"))
        .where(F.col("__line") != "")
        .select(*each.columns, _key(F.col("__line")).alias("__key"))
    )
    if page is not None:
        each, on = each.distinct(), on.distinct()
    totals = each.groupBy("__site").agg(F.count("*").alias("__pages"))
    counts = (
        on.groupBy("__site", "__key")
        .agg(F.count("*").alias("__n"))
        .where(F.col("__n") >= min_pages)
    )
    totals = totals.withColumnRenamed("__site", "__of")
    return (
        counts.join(totals, F.col("__site").eqNullSafe(F.col("__of")))
        .where(F.col("__n") > F.lit(ratio) * F.col("__pages"))
        .groupBy("__site")
        .agg(F.collect_list("__key").alias("__keys"))
    )


def drop_boilerplate(
    docs: DataFrame,
    site: str,
    text: str = "text",
    lines: Column | None = None,
    ratio: float = 0.05,
    min_pages: int = 3,
    copies: bool = True,
) -> DataFrame:
    """``docs`` with ``text`` free of boilerplate lines, ``n_lines``, ``n_boilerplate``, the number of lines over the ratio,
    ``n_dropped``, the number of lines that went, and the characters of all lines, ``line_chars``, and of those over the
    ratio, ``boilerplate_chars``, which tell the pages that are mostly boilerplate.

    ``lines`` is an array column (default: the text split at line ends); what remains is joined by line ends. Lines are
    compared without white space at their ends; empty ones never count. A line must be on ``min_pages`` pages and on
    more than ``ratio`` of the site's pages; then it goes from all of them, whatever its share of a page. Without
    ``copies`` rows of a site with equal text count as one page, so that copies of a text do not make its lines
    boilerplate; with them repeated rows are pages of their own. NULL text stays NULL with 0 lines; rows without a site
    form a site; an empty table stays empty. Characters are those without white space at the ends of a line. ``text``
    keeps its place; columns named like the counts are replaced.
    """
    if lines is None:
        lines = F.split(F.col(text), "\n")
    lines = F.coalesce(lines, F.array().cast("array<string>"))
    page = None if copies else _key(F.col(text))
    found = staged(boilerplate(docs, site, lines, ratio, min_pages, page), "boilerplate")
    added = ("n_lines", "n_boilerplate", "n_dropped", "line_chars", "boilerplate_chars")
    # the site may be a column that a caller replaces, so what is read is taken before the row is boxed
    rows = boxed(docs, text, *added, site=F.col(site), blank=F.col(text).isNull(), lines=lines)
    listed = F.coalesce(F.col("__keys"), F.array().cast("array<struct<a:bigint,b:int>>"))
    joined = rows.join(found, F.col("site").eqNullSafe(F.col("__site")), "left").withColumn("keys", listed)
    hit = lambda x: F.array_contains(F.col("keys"), _key(_bare(x)))
    some, none = F.size("keys") > 0, F.array().cast("array<string>")
    chars = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + F.length(_bare(x)))
    # lambdas see the caller's names once the row is unboxed, so they are done before
    parted = joined.withColumns(
        {
            "left": F.when(some, F.filter("lines", lambda x: ~hit(x))).otherwise(F.col("lines")),
            "over": F.when(some, F.filter("lines", hit)).otherwise(none),
        }
    ).withColumns({"all_chars": chars(F.col("lines")), "over_chars": chars(F.col("over"))})
    out = unboxed(
        parted,
        F.when(~F.col("blank"), F.array_join("left", "\n")).alias(text),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("over").cast("long").alias("n_boilerplate"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
        F.col("all_chars").alias("line_chars"),
        F.col("over_chars").alias("boilerplate_chars"),
    )
    return out.select(*(column(c) for c in [*(c for c in docs.columns if c not in added), *added]))
