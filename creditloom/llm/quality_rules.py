"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule, so that a policy, a set of rules under a version,
is a bitwise test, and ablations are bitwise aggregates: no text is read again.

Everything is built-in column expressions inside one scan without a shuffle.

Defined results: a null text counts as an empty one; a null id is carried like
any other value; repeated rows are judged row by row; an empty table gives an
empty ledger; extra columns of the input are ignored unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim")


@dataclass(frozen=True)
class Rule:
    """A named predicate over the measurements that is true where a document fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """The rules that reject a document, under a version."""

    version: str
    rules: tuple[str, ...]


# A rule keeps its place, hence its bit, for ever; new rules are appended.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("short_mean_word", "word_chars < 2 * n_words"),
    Rule("long_mean_word", "word_chars > 24 * n_words"),
    Rule("upper_case", "100 * n_upper > 50 * word_chars"),
    Rule("exclamations", "100 * n_exclaim > 50 * n_words"),
)

BASE = Policy("base-1", ("few_words", "repeated_words"))
STRICT = Policy("strict-1", tuple(r.name for r in RULES))


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the measurements of every whole text.

    A word position counts as repeated when it lies in a three-word window that
    occurs at least twice in the text. Windows are sorted by hash next to their
    position inside the row; equal neighbours are repeats.
    """
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("w", F.array_remove(F.split("t", SPACE), ""))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD_CHARACTER)))
    windows = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    rows = rows.select(
        *[f"k{i}" for i in range(len(keep))],
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), "!"))).cast("long").alias("n_exclaim"),
        F.sort_array(windows).alias("s"))
    rows = rows.withColumn("s", F.filter("s", lambda x, i: F.coalesce(
        (F.get("s", i - 1)["h"] == x["h"]) | (F.get("s", i + 1)["h"] == x["h"]),
        F.get("s", i - 1)["h"] == x["h"], F.get("s", i + 1)["h"] == x["h"], F.lit(False))))
    rows = rows.withColumn("p", F.sort_array(F.transform("s", lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                       *[(covered.cast("long") if m == "n_repeat_words" else F.col(m)).alias(m) for m in MEASURES])


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns, the measurements and ``failure_bits``: bit i is set where rule i fails."""
    # Not deterministic in the optimizer's eyes: so a filter on the bits does not copy the measurements into itself,
    # where arrays would be computed anew for each of their elements.
    bits = F.monotonically_increasing_id().bitwiseAND(F.lit(0).cast("long"))
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, text, keep).withColumn("failure_bits", bits)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    """The bits a policy looks at; a rule it names must exist."""
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[name] for name in policy.rules)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the policy failed."""
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def passing(docs: DataFrame, policies: tuple[Policy, ...], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that pass every policy."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    judged = ledger(docs.toDF(*columns), columns[docs.columns.index(text)], tuple(columns), rules)
    for policy in policies:
        judged = judged.where(passes(policy, rules))
    return judged.select(*columns).toDF(*docs.columns)


def ablations(table: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: one row per rule.

    ``failed``: documents that fail the rule; ``only``: documents that no other
    rule of the policy rejects, which are kept once the rule is left out.
    Documents are first counted per pattern of failed bits, at most 2^rules rows.
    """
    whole = F.lit(mask(policy, rules)).cast("long")
    patterns = table.select(F.col("failure_bits").bitwiseAND(whole).alias("bits")).groupBy("bits").agg(
        F.count("*").alias("n"))
    names = {r.name: i for i, r in enumerate(rules)}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << names[n]).cast("long").alias("bit"))
                               for n in policy.rules]))
    rows = patterns.withColumn("r", each).select("bits", "n", "r.*")
    return rows.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("only"))


def rejected_together(table: DataFrame, by: list[str]) -> DataFrame:
    """Per group: bits that some document fails, and bits that every document fails."""
    return table.groupBy(*by).agg(F.bit_or("failure_bits").alias("any_bits"), F.bit_and("failure_bits").alias("all_bits"),
                                  F.count("*").alias("n"))
