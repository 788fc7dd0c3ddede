"""The pipeline against a plain version of every stage on one small folder."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import string_tiling
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Test documents with odd rows and columns that share names with what the operators add."""
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    long = " ".join(f"w{i}" for i in range(5000))
    odd = [
        (9001, None, "en", "src1", 0), (9002, "", None, None, None), (None, long, "en", "src2", 1), (9003, long, "en", "src2", 1),
        (9004, long + " tail", "en", None, 1), (9004, long + " tail", "en", None, 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    docs.withColumns({"n_words": F.lit(-1), "copies": F.lit("x"), "__row_": F.lit(1)}).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return out


def contaminated(text, items):
    doc = tokens(text)
    grams = {tuple(doc[i : i + 5]) for i in range(len(doc) - 4)}
    for item in items:
        if 0 < len(item) < 5 and any(doc[i : i + len(item)] == item for i in range(len(doc))):
            return True
        if any(tuple(item[i : i + 5]) in grams for i in range(len(item) - 4)):
            if sum(brute.tiled(item, doc, 5)) >= string_tiling.Params().coverage * len(item):
                return True
    return False


def tokens(text):
    import re
    import string

    return [t for t in re.split("[" + re.escape(string.punctuation + " \t\n\x0b\x0c\r") + "]+", (text or "").translate(brute.LOWER)) if t]


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_near_copies_just_above_four_fifths_are_linked(spark, folder):
    base = [f"w{i}" for i in range(200)]

    def changed(n):
        """One word in each of n places far apart: 5 of the 196 shingles go for each."""
        return " ".join(f"new{i}" if i % 12 == 5 and i // 12 < n else w for i, w in enumerate(base))

    rows = [(1, changed(0)), (2, changed(4)), (3, " ".join(f"x{w}" for w in base)), (4, " ".join(f"x{w}" for w in changed(5).split()))]
    same = lambda a, b: len(a & b) / len(a | b)
    one, two, three, four = (brute.shingles(t) for _, t in rows)
    assert 0.8 <= same(one, two) < 0.85 and same(three, four) < 0.8
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()) == [1, 3, 4]


def test_near_dedup_equals_brute_force_at_its_own_similarity(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = lambda percent: {d: c for (d, _), (_, c, _) in zip(rows, brute.components(rows, percent))}
    want = groups(80)
    assert want != groups(85)
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()}
    assert got == {d for d, c in want.items() if d == c}


def test_run_equals_the_plain_version_with_links_at_four_fifths(spark, folder):
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [tokens(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [r for r in rows if not brute.rejected(brute.quality(r["text"]))]
    texts = brute.without_lines([(r["source"], r["text"]) for r in rows], corpus_pipeline.LINE_RATIO, corpus_pipeline.LINE_DOCUMENTS)
    rows = [{**r, "text": t, "n_chars": len(t)} for r, t in zip(rows, texts)]
    groups = collections.defaultdict(list)
    for r, (_, _, group) in zip(rows, brute.components([(r["doc_id"], r["text"]) for r in rows], 80)):
        groups[group].append(r)
    rows = [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    rows = [r for r in rows if not contaminated(r["text"], items)]
    names = sorted({r["source"] for r in rows if r["source"] is not None}) + [None] * any(r["source"] is None for r in rows)
    sizes = [sum(len(brute.words(r["text"])) for r in rows if r["source"] == n) for n in names]
    rate = {n: t / s if s else 0.0 for n, t, s in zip(names, brute.targets(sizes), sizes)}

    out = corpus_pipeline.run(spark, folder)
    got = [r.asDict() for r in out.collect()]
    plain = [c for c in out.columns if c != "copy"]
    assert plain == spark.read.parquet(f"{folder}/documents.parquet").columns
    assert {tuple(r[c] for c in plain) for r in got} <= {tuple(r[c] for c in plain) for r in rows}
    copies = collections.Counter(r["doc_id"] for r in got)
    for r in rows:
        assert copies[r["doc_id"]] in (int(rate[r["source"]]), int(rate[r["source"]]) + 1)
    assert abs(sum(copies.values()) - sum(rate[r["source"]] for r in rows)) < 40


def test_line_dedup_spares_no_page_and_no_copy_is_emptied(spark, folder):
    menu = [f"a long menu entry with number {i}" for i in range(6)]
    rows = [(k, "\n".join([*menu, f"own {k}"])) for k in range(5)] + [(10 + k, f"some text {k}\nmore text {k}") for k in range(20)]
    copied = "one text that stands here\nnine times"
    rows += [(50 + k, copied) for k in range(9)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.line_dedup(spark, docs, folder).collect()}
    want = {d: f"own {d}" if d < 5 else t for d, t in rows}
    assert got == {d: (t, len(t)) for d, t in want.items()}
