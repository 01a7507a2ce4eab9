"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and
a long with one failure bit per rule. Policies are versioned masks over these
bits: a document is kept under a policy when no bit of its mask is set. Changing
or comparing policies then needs no text: ``apply_policies`` and ``ablations`` work
on the masks alone.

Edge cases: null and empty texts have no words and all measurements 0; a text
without words fails ``few_words`` and no ratio rule; equal rows give equal ledger
rows; texts of any length are measured whole; an empty table gives an empty ledger;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of


@dataclass(frozen=True)
class Rule:
    """Fails where the condition (SQL over the measurement columns) holds."""

    name: str
    fails: str


#: The position in this list is the bit. Conditions compare integers only.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("shouting", "2 * n_upper > n_letters AND n_letters > 0"),
    Rule("exclamations", "4 * n_exclaim > n_words"),
]
BASE_RULES = ["few_words", "repeated_words"]


def mask(names: list[str], rules: list[Rule] = RULES) -> int:
    """The bits of the named rules."""
    at = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << at[n] for n in names)


#: Policy versions. A new version is a new entry; old ones stay to be compared.
POLICIES = {
    "base": mask(BASE_RULES),
    "v1": mask([*BASE_RULES, "many_symbols", "repeated_lines"]),
    "v2": mask([r.name for r in RULES]),
}
CURRENT = "v2"


def _count_of(c: Column, others: str) -> Column:
    """Number of characters left when runs of the others are removed."""
    return F.char_length(F.regexp_replace(c, others, "")).cast("long")


def _repeat_words() -> list[tuple[str, str]]:
    """Steps that count the words inside 3-word windows occurring twice or more.

    Window hashes and positions are packed into longs and sorted; neighbours with
    equal hash bits are suspects. Only suspects are compared by their words.
    """
    adjacent = ("({a}[j].g = {a}[j-1].g)", "({a}[j].g = {a}[j+1].g)")
    return [
        ("bits", "cast(ceil(log2(n_words + 1)) as int)"),
        ("packed", "CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> "
                   "shiftleft(shiftrightunsigned(xxhash64(words[i], words[i+1], words[i+2]), bits + 1), bits) + i)) "
                   "ELSE cast(array() as array<bigint>) END"),
        ("suspects", "transform(filter(sequence(0, size(packed)), j -> j < size(packed) AND ("
                     "(j > 0 AND shiftright(packed[greatest(j-1, 0)], bits) = shiftright(get(packed, j), bits)) OR "
                     "(j < size(packed) - 1 AND shiftright(get(packed, j+1), bits) = shiftright(get(packed, j), bits)))), "
                     "j -> cast(packed[j] - shiftleft(shiftright(packed[j], bits), bits) as int))"),
        ("grams", "array_sort(transform(suspects, p -> struct(concat_ws(' ', words[p], words[p+1], words[p+2]) as g, p as p)))"),
        ("starts", "sort_array(transform(filter(sequence(0, size(grams)), j -> j < size(grams) AND ("
                   "(j > 0 AND get(grams, j-1).g = get(grams, j).g) OR "
                   "(j < size(grams) - 1 AND get(grams, j+1).g = get(grams, j).g))), j -> grams[j].p))"),
        ("n_repeat_words", "aggregate(sequence(0, size(starts)), 0L, (acc, j) -> acc + CASE "
                           "WHEN j >= size(starts) THEN 0 WHEN j = size(starts) - 1 THEN 3 "
                           "ELSE least(3, get(starts, j+1) - get(starts, j)) END)"),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", t.alias("t"))
    d = d.withColumn("words", words_of(F.col("t")))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0))
    letters = r"[^\p{L}]+"
    d = d.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        _count_of(F.col("t"), r"[\x20\x09-\x0D]+").alias("word_chars"),
        _count_of(F.col("t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count_of(F.col("t"), letters).alias("n_letters"),
        _count_of(F.col("t"), r"[^\p{Lu}]+").alias("n_upper"),
        _count_of(F.col("t"), r"[^!]+").alias("n_exclaim"))
    for name, sql in _repeat_words():
        d = d.withColumn(name, F.expr(sql))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                    "n_letters", "n_upper", "n_exclaim")


def ledger(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Measurements and failure bits per document; each rule is evaluated once."""
    bits = F.lit(0).cast("long")
    for k, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed", bits)


def passes(policy_mask: int, failed: str = "failed") -> Column:
    """Whether no rule of the mask has failed."""
    return F.col(failed).bitwiseAND(F.lit(policy_mask).cast("long")) == 0


def apply_policies(rows: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """The ledger with one boolean kept_<version> per policy."""
    return rows.select("*", *[passes(m).alias(f"kept_{v}") for v, m in policies.items()])


def ablations(rows: DataFrame, rules: list[Rule] = RULES, policies: dict[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: documents the rule fails, those it alone removes under
    the policy, and the documents kept if it were left out.

    Documents are first counted per distinct bit pattern, so what is compared
    with the policies has at most 2**len(rules) rows.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"))
    asked = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"),
                               F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                      for v, m in policies.items() for k, r in enumerate(rules) if m >> k & 1])
    x = patterns.select("failed", "n", F.explode(asked).alias("a")).select("failed", "n", "a.*")
    under = F.col("failed").bitwiseAND(F.col("mask"))
    without = under.bitwiseAND(F.bitwise_not(F.col("bit")))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return x.groupBy("policy", "rule").agg(
        total(under.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(under == F.col("bit")).alias("n_only"),
        total(without == 0).alias("n_kept_without"),
        total(under == 0).alias("n_kept"))
