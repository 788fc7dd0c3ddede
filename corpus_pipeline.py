"""From raw documents to a training mix.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, and returns a DataFrame with the
columns of docs; the last one adds the number of the copy. Stages are written to the shared folder and read again, so a
lost executor costs the running stage at most. Columns that documents have beyond the known ones pass through, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.llm.columns import read_table, staged
from eventloom.llm.line_frequency import drop_boilerplate
from eventloom.llm.minhash_bayes import Params, one_of_each
from eventloom.llm.mixing import emit, mix_sources
from eventloom.llm.quality_ledger import STRICT, failed, ledger
from eventloom.llm.string_tiling import decontaminated

#: A line on more than this share of a source's distinct documents is boilerplate.
LINE_RATIO, LINE_DOCUMENTS = 0.05, 3

#: Documents at a similarity of 0.8 are near duplicates; such a pair shares no band with probability 1e-7.
NEAR = Params(percent=80, bands=40, rows=5, batch=40)


def _wrapped(docs: DataFrame, *needed: str) -> DataFrame:
    """The whole row as one column next to the columns an operator reads, out of reach of the names it adds."""
    return docs.select(F.struct(*docs.columns).alias("__doc"), *needed)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the strict policy rejects; repeated rows stay repeated."""
    return ledger(_wrapped(docs, "text")).where(~failed(STRICT)).select("__doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines, whatever their share of the document; copies of a text count
    once, so that they are left for the near-dedup. ``n_chars`` follows the text. No document goes."""
    rest = [c for c in docs.columns if c != "text"]
    narrow = docs.select(F.struct(*rest).alias("__doc"), "source", "text")
    found = drop_boilerplate(narrow, "source", ratio=LINE_RATIO, min_pages=LINE_DOCUMENTS, copies=False)
    out = found.select("__doc.*", "text")
    if "n_chars" in rest:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(chars, F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return one_of_each(docs, p=NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, with the number of the copy as ``copy``."""
    taken = emit(mix_sources(_wrapped(docs, "doc_id", "source", "text")))
    name = "copy" if "copy" not in docs.columns else "mix_copy"
    return taken.select("__doc.*", F.col("copy").alias(name))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

#: Band hashes and tiles have no SQL form; the tests hold run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
