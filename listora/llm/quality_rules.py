"""Quality rules as a ledger of failure bits.

Each document's measurements are taken once, in column expressions over its whole text. Every rule is then evaluated once,
and the rules a document fails are stored as bits of one number beside the measurements. A policy is a versioned mask over
these bits: a stored ledger answers any policy, and what each rule of a policy does to a corpus, without a text being read
again. All of it is DataFrame functions; nothing runs in Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5  # words in a window that may repeat
_ANY_LENGTH = 1 << 30
_SPACE = r"[\x20\x09-\x0D]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]"
_NOT_SYMBOL = r"[^#*$%&|<>]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_shouts")


@dataclass(frozen=True)
class Rule:
    """A rule by the bit it sets; `fails` is SQL over the measurements. Bits of a rule never change once ledgers are kept."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "upper_case", "2 * n_upper > n_letters"),
    Rule(5, "shouting", "10 * n_shouts > n_words"),
    Rule(6, "few_letters", "100 * n_letters < 40 * word_chars"),
    Rule(7, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A verdict over the ledger: a document that fails more than `allowed` of the named rules goes."""

    name: str
    version: int
    rules: tuple[str, ...]
    allowed: int = 0

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {rule.name: 1 << rule.bit for rule in rules}
        return reduce(or_, (bits[name] for name in self.rules), 0)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy("prose", 1, tuple(rule.name for rule in RULES))


def _removed(pattern: str) -> Column:
    """Code points left of the text when all that matches goes."""
    return F.length(F.regexp_replace("_text", pattern, "")).cast("long")


def _with_windows(rows: DataFrame, items: str, name: str, joined) -> DataFrame:
    """Adds all runs of five items, joined pair by pair.

    Arrays are shifted against each other, so no lambda looks outside, and each step is a column read twice, which the
    optimiser does not fold into its readers.
    """

    def step(rows: DataFrame, left: str, right: str, by: int, out: str) -> DataFrame:
        return rows.withColumn(out, F.zip_with(left, F.slice(right, by + 1, _ANY_LENGTH), joined))

    rows = step(rows, items, items, 1, "_two")
    rows = step(rows, "_two", "_two", 2, "_four")
    rows = step(rows, "_four", items, 4, "_five")
    whole = F.slice("_five", 1, F.greatest(F.size(items) - (WINDOW - 1), F.lit(0)))
    return rows.withColumn(name, whole).drop("_two", "_four", "_five")


def _covered(in_order: Column) -> Column:
    """Words covered by windows found twice or more; `in_order`: (window, place) in order."""
    twins = F.zip_with(
        in_order, F.slice(in_order, 2, _ANY_LENGTH),
        lambda left, right: F.when(left["window"] == right["window"], F.array(left["place"], right["place"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda pair: pair.isNotNull()))))
    zero = F.lit(0).cast("long")
    return F.aggregate(
        places,
        F.struct(zero.alias("words"), zero.alias("end")),
        lambda so_far, place: F.struct(
            (so_far["words"] + WINDOW - F.greatest(so_far["end"] - place, zero)).alias("words"), (place + WINDOW).alias("end")
        ),
        lambda so_far: so_far["words"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id (as it is) and the measurements of each row's whole text, as longs; see `ledger` for special cases.

    n_words: runs of characters other than ASCII white space; word_chars: code points in them; n_symbols: characters of
    ``#*$%&|<>``; n_lines: lines (split at line feeds) with a word; n_dup_lines: those equal to an earlier line;
    n_repeat_words: words in windows of five words that the text has twice or more; n_letters, n_upper: letters, and
    upper-case ones; n_shouts: exclamation marks.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    words = F.filter(F.split("_text", _SPACE), lambda word: word != "")
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(_NOT_SPACE))
    cut = rows.select("doc_id", "_text", words.alias("_words"), lines.alias("_lines"))
    counted = cut.select(
        "doc_id",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _removed(_NOT_SYMBOL).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _removed(r"\P{L}+").alias("n_letters"),
        _removed(r"\P{Lu}+").alias("n_upper"),
        _removed(r"[^!]+").alias("n_shouts"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    # windows that differ in their hashes differ; only texts with equal hashes, few of them, have their windows compared
    hashed = _with_windows(counted, "_hashes", "_keys", lambda left, right: F.xxhash64(left, right))
    again = F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), F.col("_words"))
    told = _with_windows(hashed.withColumn("_again", again), "_again", "_windows", lambda left, right: F.concat_ws(" ", left, right))
    placed = F.transform("_windows", lambda window, i: F.struct(window.alias("window"), i.cast("long").alias("place")))
    found = F.coalesce(_covered(F.col("_in_order")), F.lit(0).cast("long"))
    return told.withColumn("_in_order", F.sort_array(placed)).select(
        "doc_id", *[found.alias(name) if name == "n_repeat_words" else F.col(name) for name in MEASURES]
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measurements, and `failed`: a long whose bit `rule.bit` is set where the rule fails.

    One row for each row of `docs`, repeated rows and rows that share a doc_id included; a null doc_id stays null. A null
    text is read as an empty one: all measurements are 0. Columns other than doc_id and text are left out, whatever their
    names. An empty table gives an empty ledger. One pass without a shuffle; a text is held in a few arrays of one task, so
    memory follows the longest text.
    """
    if len({rule.bit for rule in rules}) < len(rules) or any(not 0 <= rule.bit < 63 for rule in rules):
        raise ValueError("each rule needs a bit of its own, from 0 to 62")
    failed = reduce(lambda bits, rule: bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")), rules, F.lit(0).cast("long"))
    return measured(docs).withColumn("failed", failed)


def verdicts(ledger_rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with `kept` and the name and version of the policy that says so. Rows, nulls and ties: as in the ledger."""
    breaches = F.bit_count(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")))
    return ledger_rows.withColumns(
        {"policy": F.lit(policy.name), "policy_version": F.lit(policy.version), "kept": breaches <= policy.allowed}
    )


def ablations(ledger_rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """What each rule of a policy does, by groups of ledger columns: (by...), rule, n_failed, n_alone, n_kept, n_kept_without.

    n_failed: documents that fail the rule; n_alone: that only this rule drops; n_kept: that the policy keeps;
    n_kept_without: that it would keep without the rule. Rows collapse to distinct failure bits before anything else, at
    most one for each combination of rules and group, so the shuffle does not grow with the documents. A group that a
    nullable column names null is a group of its own. No rows give no rows.
    """
    mask = policy.mask(rules)
    patterns = ledger_rows.groupBy(*by, F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("_bits")).agg(F.count(F.lit(1)).alias("_n"))
    chosen = [rule for rule in rules if mask >> rule.bit & 1]
    if not chosen:
        raise ValueError("the policy has no rule")
    each = F.explode(F.array(*[F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << rule.bit).cast("long").alias("bit")) for rule in chosen]))
    kept = F.bit_count("_bits") <= policy.allowed
    without = F.bit_count(F.col("_bits").bitwiseAND(F.bitwise_not(F.col("_each.bit")))) <= policy.allowed
    fails = F.col("_bits").bitwiseAND(F.col("_each.bit")) != 0
    return (
        patterns.withColumn("_each", each)
        .groupBy(*by, F.col("_each.rule").alias("rule"))
        .agg(*[F.coalesce(F.sum(F.when(how, F.col("_n"))), F.lit(0)).alias(name) for name, how in (
            ("n_failed", fails), ("n_alone", without & ~kept), ("n_kept", kept), ("n_kept_without", without))])
    )


def failures_by(ledger_rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by...), any_failed, all_failed: rules that some, and that all, documents of a group fail, as bits."""
    return ledger_rows.groupBy(*by).agg(F.bit_or("failed").alias("any_failed"), F.bit_and("failed").alias("all_failed"))


def kept_documents(docs: DataFrame, policy: Policy = PROSE, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measurements, failed, policy, policy_version, kept: a ledger and a verdict in one pass."""
    return verdicts(ledger(docs, rules), policy, rules)


def rule_table(rules: Sequence[Rule] = RULES) -> Mapping[int, str]:
    """Names of the rules by bit, to be kept beside a stored ledger."""
    return {rule.bit: rule.name for rule in rules}
