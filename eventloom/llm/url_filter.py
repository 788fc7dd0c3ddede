"""URL verdicts from host rules and a list of blocked URLs.

The list is held as a blocked Bloom filter: a table of 256-bit blocks, four bits set per URL, all in one block. A page
meets one filter row, and only pages whose four bits are set go on to the exact join with the listed URLs, which takes
the false positives out. Built-in column expressions throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.llm.columns import ascii_lower, boxed, staged, unboxed

LANES = 4
BITS_PER_URL = 16
#: Rules are a policy written by people and compiled into one expression; long host lists belong into the URL list.
MOST_RULES = 1000
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling per URL: no scheme, ``www.``, fragment, closing slashes or tracking parameters; parameters sorted.

    NULL for NULL and for text without ``://``.
    """
    kept = F.array_sort(
        F.filter(
            F.split(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)
        )
    )
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    plain = F.concat(
        F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""), query
    )
    return F.when(F.instr(url, "://") > 0, plain)


def fitting_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL without one."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; put hosts into the URL list instead")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.text)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _slot(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), url), F.lit(blocks).cast("long"))


def _bits(url: Column) -> list[Column]:
    """One bit in each of the lanes, from one hash."""
    h = F.xxhash64(F.lit(2), url)
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * lane).bitwiseAND(F.lit(63)).cast("int")
        )
        for lane in range(LANES)
    ]


def bloom_filter(urls: DataFrame, blocks: int, url: str = "listed_url") -> DataFrame:
    """The filter's blocks that have a bit set: ``slot`` and one word per lane."""
    bits = {f"word{lane}": bit for lane, bit in enumerate(_bits(F.col(url)))}
    return (
        urls.select(_slot(F.col(url), blocks).alias("slot"), *(bit.alias(name) for name, bit in bits.items()))
        .groupBy("slot")
        .agg(*(F.bit_or(name).alias(name) for name in bits))
    )


def filter_blocks(n_urls: int, bits_per_url: int = BITS_PER_URL) -> int:
    return max(1, -(-n_urls * bits_per_url // (64 * LANES)))


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: tuple[HostRule, ...] = (), url: str = "url", listed_url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` (boolean) and ``verdict`` (allow or block).

    The longest fitting rule decides; without one a page is blocked if its canonical URL is that of a listed URL. NULL
    and unparsable URLs have empty host and path, fit no rule and are never listed. Repeated pages are judged alike,
    repeated list entries count once, an empty list blocks nothing. Columns of the same names are replaced.
    """
    names = staged(
        listed.select(canonical(F.col(listed_url)).alias("listed_url")).where("listed_url IS NOT NULL").distinct(),
        "listed-urls",
    )
    blocks = filter_blocks(names.count())
    bloom = staged(bloom_filter(names, blocks), "bloom-filter", small=True)
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    added = ("host", "path", "rule", "listed", "verdict")
    parsed = (
        boxed(pages, host=host_of(F.col(url)), path=path_of(F.col(url)), url=canonical(F.col(url)))
        .withColumns({"rule": name, "ruled": verdict})
        .withColumn("slot", F.when(F.col("url").isNotNull(), _slot(F.col("url"), blocks)))
    )
    mine = bloom.withColumnRenamed("slot", "at")
    hit = F.lit(True)
    for lane, bit in enumerate(_bits(F.col("url"))):
        hit = hit & (F.col(f"word{lane}").bitwiseAND(bit) != 0)
    probed = parsed.join(mine, F.col("slot") == F.col("at"), "left").withColumn("hit", F.coalesce(hit, F.lit(False)))
    probed = probed.select("row", "host", "path", "url", "rule", "ruled", "hit")
    sure = probed.where("hit").join(names, F.col("url") == F.col("listed_url"), "left")
    both = (
        sure.withColumn("listed", F.col("listed_url").isNotNull())
        .drop("listed_url")
        .unionByName(probed.where("NOT hit").withColumn("listed", F.lit(False)))
    )
    decided = F.coalesce(F.col("ruled"), F.when(F.col("listed"), "block").otherwise("allow"))
    return unboxed(both.withColumn("verdict", decided), *added, but=added)
