"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one ``fail_bits``
number per document, bit k being set where rule k fails.  Policies are masks over these bits, so any
number of versions, and the effect of leaving a rule out, come from the stored ledger by bitwise
arithmetic without reading a text again.

All work is done with built-in column functions; a document never leaves its row, so there is no
shuffle and no hot key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``failed`` gets a lookup of measurement columns and says whether the rule fails."""

    name: str
    bit: int
    failed: Callable[[Callable[[str], Column]], Column]

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule("few_words", 0, lambda m: m("n_words") < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", 2, lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", 3, lambda m: 100 * m("n_dup_lines") > 60 * m("n_lines")),
    Rule("short_words", 4, lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", 5, lambda m: m("word_chars") > 20 * m("n_words")),
    Rule("exclaiming", 6, lambda m: 10 * m("n_exclaims") > 5 * m("n_words")),
)

#: Versioned policies: a document is kept if none of the policy's rules failed.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "web-1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "web-2": tuple(rule.name for rule in RULES),
}
CURRENT = "web-2"
BASE = "base-1"


def policy_mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(rule.mask for rule in RULES if rule.name in POLICIES[policy])


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and one column per measurement, all ``long``, for every row of ``docs``.

    A null text counts as empty: every measurement is 0.  Repeated rows are measured each on its own.
    Other columns of ``docs`` are not read, so their names may be anything.

    ``n_repeat_words`` counts the words that lie in a window of three words which the text holds twice
    or more.  The windows are compared as strings; only texts that repeat one are sorted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(WORD))
    rows = rows.select(
        "id",
        F.length(F.translate("t", _SPACES, "")).cast("long").alias("word_chars"),
        _count_of(F.col("t"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("t"), "!").alias("n_exclaims"),
        lines.alias("lines"),
        F.regexp_extract_all("t", F.lit(WORD), 0).alias("words"),
    )
    n = F.size("words")
    words = F.col("words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    rows = rows.select(
        "id",
        "word_chars",
        "n_symbols",
        "n_exclaims",
        n.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    placed = F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("sorted", F.when(F.size("windows") > F.size(F.array_distinct("windows")), placed))
    run = F.col("sorted")
    twice = F.filter(
        F.transform(
            run,
            lambda e, k: F.when((e["w"] == F.get(run, k - 1)["w"]) | (e["w"] == F.get(run, k + 1)["w"]), e["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))
    rows = rows.withColumn("n_repeat_words", F.when(run.isNotNull(), covered).otherwise(0).cast("long"))
    return rows.select(F.col("id").alias(id_col), *MEASUREMENTS)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measured`` with ``fail_bits``: every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.failed(F.col), F.lit(rule.mask)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def passes(policy: str, bits: str = "fail_bits") -> Column:
    """True where no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablations(stored: DataFrame, policy: str = CURRENT, bits: str = "fail_bits") -> DataFrame:
    """One row per rule of the policy: what happens to the kept documents if the rule is left out.

    ``failed``: documents that the rule fails; ``only``: documents that it alone fails; ``kept`` and
    ``kept_without``: documents kept by the policy and by the policy without it.  An empty ledger gives
    rows of zeros.  The ledger is first counted by its bits, so at most 2**rules rows are ever moved.
    """
    mask = policy_mask(policy)
    counts = stored.groupBy(F.col(bits).bitwiseAND(F.lit(mask).cast("long")).alias("b")).agg(F.count("*").alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    b = F.col("b")
    per_rule = []
    for rule in (r for r in RULES if r.mask & mask):
        rest = F.lit(mask & ~rule.mask).cast("long")
        per_rule.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                total(b.bitwiseAND(F.lit(rule.mask).cast("long")) != 0).alias("failed"),
                total(b == rule.mask).alias("only"),
                total(b == 0).alias("kept"),
                total(b.bitwiseAND(rest) == 0).alias("kept_without"),
            )
        )
    return counts.agg(F.array(*per_rule).alias("rules")).select(F.inline("rules"))


def judged(docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``: the policy applied to the stored bits."""
    rows = ledger(docs, id_col, text_col)
    base_failed = ~passes(BASE)
    return rows.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & passes(policy))
