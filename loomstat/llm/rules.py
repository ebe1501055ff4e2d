"""Quality rules kept as a ledger of failure bits and measurements, and policies applied to it.

``ledger`` evaluates every rule once per text. A rule's outcome is one bit, its measurements are
columns, and nothing is decided yet. A ``Policy`` is a version and the set of rules that reject; it
is applied to the bits alone, so that trying another policy, or asking what each rule costs
(``ablation``), never looks at a text again. All of it is built-in functions: one scan, no shuffle;
the ablation aggregates one row per distinct bit pattern.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# A rule's name, in the order of the bits. Each compares whole numbers, so every engine agrees.
RULES = ("few_words", "repeated_windows", "repeated_lines", "symbols", "short_words", "long_words", "shouting")


@dataclass(frozen=True)
class Policy:
    """A version's name and the rules that reject a text."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(name) for name in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("2", RULES)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside the 5-word windows that a text holds twice or more.

    Windows are sorted by hash with their places, so that equal ones stand side by side. Only a text
    that repeats a window pays for the sort.
    """

    def windows(h: Column) -> Column:
        slots = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(slots, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def places(g: Column) -> Column:
        ranked = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ranked, lambda p: F.sort_array(F.array_compact(F.transform(p, lambda x, j: twice(p, x, j)))))

    def twice(p: Column, x: Column, j: Column) -> Column:
        beside = [F.coalesce(F.get(p, j + step)["h"] == x["h"], F.lit(False)) for step in (-1, 1)]
        return F.when(beside[0] | beside[1], x["i"])

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def count(g: Column) -> Column:
        doubles = F.size(F.array_distinct(g)) < F.size(g)
        return F.when(doubles, _let(places(g), covered)).otherwise(0)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = F.when(F.size(words) >= WINDOW, _let(hashes, lambda h: _let(windows(h), count)))
    return F.coalesce(found, F.lit(0)).cast("long")


def measured(texts: DataFrame, text: str = "text", **keep: Column) -> DataFrame:
    """``keep`` columns and the measurements of each text; a null text has no word."""
    t = F.coalesce(F.col(text), F.lit(""))
    split = texts.select(
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("_keep"),
        F.array_remove(F.split(t, SPACES), "").alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(A_WORD)).alias("_l"),
    )
    joined = split.withColumn("_j", F.array_join("_w", ""))
    return joined.select(
        "_keep.*",
        F.size("_w").cast("long").alias("n_words"),
        F.length("_j").cast("long").alias("word_chars"),
        (F.length("_j") - F.length(F.translate("_j", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_j", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("_j", "[^a-z]+", "")).cast("long").alias("n_lower"),
    )


def _failures() -> dict[str, Column]:
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": words < 10,
        "repeated_windows": F.col("n_repeat_words") * 100 > words * 20,
        "repeated_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * 60,
        "symbols": F.col("n_symbols") * 100 > words * 40,
        "short_words": chars * 10 < words * 20,
        "long_words": chars > words * 15,
        "shouting": F.col("n_upper") > F.col("n_lower"),
    }


def ledger(texts: DataFrame, text: str = "text", **keep: Column) -> DataFrame:
    """``keep`` columns, the measurements, and ``failures``: bit i is set if rule i fails.

    Null and empty texts have no word: they fail ``few_words`` and nothing else. Every row gives one
    row, whatever it repeats.
    """
    bits = F.lit(0).cast("long")
    for i, (name, fails) in enumerate(_failures().items()):
        assert RULES[i] == name
        bits = bits + F.when(fails, F.lit(1 << i)).otherwise(0)
    return measured(texts, text, **keep).withColumn("failures", bits)


def rejects(policy: Policy, failures: str | Column = "failures") -> Column:
    """True where a ledger row fails a rule of the policy."""
    bits = F.col(failures) if isinstance(failures, str) else failures
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def kept(rows: DataFrame, policy: Policy, row: str = "row") -> DataFrame:
    """The structs ``row`` of the ledger rows that the policy does not reject.

    They leave by ``explode`` and not by a filter, which Spark would push below the measurements and
    so work these out several times.
    """
    passed = F.when(~rejects(policy), F.array(row))
    return rows.select(F.explode(passed).alias(row))


def ablation(rows: DataFrame, policies: Sequence[Policy], failures: str = "failures") -> DataFrame:
    """Per policy and rule: texts that fail it, that only it rejects, and that pass without it.

    The ledger is first counted per bit pattern (at most 2**rules of them, combined before the
    shuffle); the rest works on those few rows. ``policies`` are versions to compare. An empty
    ledger gives zeros.
    """
    patterns = rows.groupBy(F.col(failures).alias("bits")).agg(F.count("*").alias("n"))
    cells = [
        F.struct(
            F.lit(p.version).alias("version"),
            F.lit(name).alias("rule"),
            F.lit(p.mask).cast("long").alias("mask"),
            F.lit(1 << RULES.index(name)).cast("long").alias("bit"),
        )
        for p in policies
        for name in p.rules
    ]
    each = patterns.select("bits", "n", F.explode(F.array(*cells)).alias("c")).select("bits", "n", "c.*")
    hit = F.col("bits").bitwiseAND(F.col("mask"))
    none = rows.sparkSession.range(1).select(F.explode(F.array(*cells)).alias("c")).select("c.version", "c.rule")
    counted = each.groupBy("version", "rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.sum(
            F.when(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0)
        ).alias("kept_without"),
    )
    zero = {name: F.coalesce(name, F.lit(0)).cast("long") for name in ("failed", "only_this", "kept_without")}
    return none.join(counted, ["version", "rule"], "left").withColumns(zero)
