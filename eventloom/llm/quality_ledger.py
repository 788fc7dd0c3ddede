"""Quality rules: every rule evaluated once into a ledger of failure bits and measurements.

A ledger row holds what was measured of a text and one bit per failed rule. Policies are versions: a name and the bits
that reject. Judging by another policy, comparing policies and finding what each rule contributes need the ledger only,
never the texts. Everything is built-in column expressions; nothing is shuffled but the counts per bit mask.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.llm.columns import words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger; ``failed`` is a condition on the measurements."""

    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: the rules that reject a text."""

    version: str
    rules: tuple[str, ...]


#: In the order of their bits; new rules go to the end, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
)
BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("v1", tuple(rule.name for rule in RULES))


def bits_of(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    names = [rule.name for rule in rules]
    return sum(1 << names.index(name) for name in set(policy.rules))


def _repeat_words(words: Column, grams: Column, order: Column, starts: Column) -> tuple[Column, Column, Column, Column]:
    """Steps of the count of words in 3-word windows that are found twice or more; each reads the one before."""
    hashes = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    ordered = F.when(
        F.size(F.array_distinct(grams)) < F.size(grams),
        F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    repeated = F.sort_array(
        F.transform(
            F.filter(
                order,
                lambda s, j: F.coalesce(F.get(order, j - 1)["h"] == s["h"], F.lit(False))
                | F.coalesce(F.get(order, j + 1)["h"] == s["h"], F.lit(False)),
            ),
            lambda s: s["i"],
        )
    )
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.coalesce(F.get(starts, k + 1) - s, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return hashes, ordered, repeated, F.coalesce(covered, F.lit(0).cast("long"))


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failures``, the bit mask of failed rules (bit k: ``rules[k]``).

    Measured are ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (those equal to an earlier one) and ``n_repeat_words`` (words in 3-word windows that occur at least
    twice, all occurrences counted). NULL and blank texts measure zero everywhere. Columns of ``docs`` with the same
    names are replaced. A row is judged by itself, so repeated rows get equal verdicts; no rows give no rows.
    """
    words, grams, order, starts = (F.col(f"__ledger_{x}") for x in ("words", "grams", "order", "starts"))
    hashes, ordered, repeated, covered = _repeat_words(words, grams, order, starts)
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    wide = (
        docs.withColumns({"__ledger_words": words_of(F.col(text)), "__ledger_lines": lines})
        .withColumn("__ledger_grams", hashes)
        .withColumn("__ledger_order", ordered)
        .withColumn("__ledger_starts", repeated)
    )
    n_lines = F.size("__ledger_lines")
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - F.size(F.array_distinct("__ledger_lines")),
        "n_repeat_words": covered,
    }
    # A filter on a measurement must not be pushed below it, or the arrays would be built anew inside the lambdas.
    # Catalyst keeps filters on the output of a generator above it; this one gives a row per row.
    once = F.inline(F.array(F.struct(*(m.cast("long").alias(name) for name, m in measures.items()))))
    measured = wide.select(*(F.col(c) for c in docs.columns if c not in measures), once)
    mask = F.lit(0).cast("long")
    for bit, rule in enumerate(rules):
        mask = mask + F.when(F.expr(rule.failed), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
    return measured.withColumn("failures", mask)


def failed(policy: Policy, failures: str = "failures", rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether the policy rejects a row of a ledger."""
    return F.col(failures).bitwiseAND(F.lit(bits_of(policy, rules)).cast("long")) != 0


def judge(ledger_rows: DataFrame, policies: tuple[Policy, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` per policy."""
    return ledger_rows.withColumns({f"kept_{p.version}": ~failed(p, rules=rules) for p in policies})


def ablation(ledger_rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: rows that fail it, and rows that only it rejects (``regained`` without the rule).

    The ledger is reduced to one row per bit mask first; an empty ledger gives zeros.
    """
    masks = ledger_rows.groupBy("failures").agg(F.count("*").alias("n"))
    names = [rule.name for rule in rules]
    bits = F.lit(bits_of(policy, rules)).cast("long")
    parts = []
    for name in policy.rules:
        bit = F.lit(1 << names.index(name)).cast("long")
        hit = F.col("failures").bitwiseAND(bits)
        parts += [
            F.coalesce(F.sum(F.when(hit.bitwiseAND(bit) != 0, F.col("n"))), F.lit(0)).alias(f"failed_{name}"),
            F.coalesce(F.sum(F.when(hit == bit, F.col("n"))), F.lit(0)).alias(f"regained_{name}"),
        ]
    rows = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(policy.version).alias("version"),
                    F.lit(name).alias("rule"),
                    F.col(f"failed_{name}").alias("failed"),
                    F.col(f"regained_{name}").alias("regained"),
                )
                for name in policy.rules
            )
        )
    ).alias("r")
    return masks.agg(*parts).select(rows).select("r.*")
