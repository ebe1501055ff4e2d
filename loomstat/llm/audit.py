"""How the filters of a cleaning step interact: who removes what, in which order, and what each is worth.

Documents are counted once by the set of filters that they fail (at most 2**m sets for m filters,
combined before the shuffle). From these few rows follow, for each coalition of filters, how many
documents it removes, and every figure of the report is a sum or a difference of coalition removals:
applying filter ``f`` after the filters ``s`` removes ``v(s + f) - v(s)`` documents. The Shapley value,
a filter's share of all removals, is the solution of least squares over the proper coalitions: each
equation says that a coalition's filters together are worth what the coalition removes, its weight is
``(m - 1) / (C(m, k) k (m - k))`` for k filters, and the shares must add up to what all filters remove.
The normal equations are solved in rational numbers, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_FILTERS = 7  # 7! orders; the number of rows is part of the definition

GAPS = r"[\x20\x09-\x0D]+"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: str) -> dict[str, Column]:
    """Filters that look at one text; the column is not null.

    ``A`` under 200 words, ``B`` under half of the words distinct, ``C`` more than 3 in 100 characters
    A-Z, ``D`` any of ``#$%&*|``. Words are runs without blanks and the control characters 09-0D.
    """
    t = F.col(text)
    words = F.filter(F.split(t, GAPS), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": F.regexp_count(t, F.lit("[A-Z]")) * 100 > F.length(t) * 3,
        "D": t.rlike("[#$%&*|]"),
    }


def failure_bits(fails: Sequence[Column]) -> Column:
    """Bit i is set where the i-th condition holds; an unknown condition counts as passed."""
    return reduce(lambda bits, x: bits + x, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)])


def failure_patterns(
    docs: DataFrame, marks: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """``part, bits, n, good, toxic``: documents by the filters of ``text_filters`` that they fail and,
    as the last bit, by whether a smaller key has the same text.

    ``marks`` holds ``quality`` and ``toxic`` per key: a document is good (toxic) if any of its marks is
    1. A null text is empty, a null part is the empty string. A null key has no mark, no smaller key
    and is smaller than none; rows that repeat a key repeat no *smaller* one.

    Texts are compared by SHA-256. Copies are counted per (text, part, marks) before they meet, so a
    text with a third of all rows is a few rows when its least key is looked up.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    seen = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), t.alias("_text")
    )
    alone = text_filters("_text")
    seen = seen.select(
        "_key", "_part", F.unhex(F.sha2("_text", 256)).alias("_same"), failure_bits(list(alone.values())).alias("_bits")
    )
    counted = seen.groupBy("_key", "_part", "_same", "_bits").agg(F.count("*").alias("_n"))

    def any_one(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    known = marks.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    known = known.agg(any_one("quality").alias("_good"), any_one("toxic").alias("_toxic"))
    marked = counted.join(known, "_key", "left").fillna(0, ["_good", "_toxic"])
    copies = marked.groupBy("_same", "_bits", "_part", "_good", "_toxic").agg(
        F.sum("_n").alias("_n"),
        F.min("_key").alias("_least"),
        F.min_by("_n", "_key").alias("_at_least"),
        F.sum(F.when(F.col("_key").isNull(), F.col("_n"))).alias("_no_key"),
    )
    least = F.min("_least").over(Window.partitionBy("_same"))
    copies = copies.withColumn("_first", F.when(F.col("_least") == least, F.col("_at_least")))
    stay = F.coalesce("_first", F.lit(0)) + F.coalesce("_no_key", F.lit(0))
    again = F.lit(1 << len(alone))
    both = F.array(
        F.struct(F.col("_bits").alias("bits"), stay.alias("n")),
        F.struct((F.col("_bits") + again).alias("bits"), (F.col("_n") - stay).alias("n")),
    )
    each = copies.select("_part", "_good", "_toxic", F.explode(both).alias("c")).filter(F.col("c.n") > 0)
    return each.groupBy(F.col("_part").alias("part"), F.col("c.bits").alias("bits")).agg(
        F.sum("c.n").alias("n"),
        F.sum(F.col("c.n") * F.col("_good")).alias("good"),
        F.sum(F.col("c.n") * F.col("_toxic")).alias("toxic"),
    )


def coalition_removals(bits: Sequence[int], counts: Sequence[int], m: int) -> list[int]:
    """For each of the 2**m coalitions (as a bit set): the sum of counts that fail any of its filters."""
    return [sum(int(n) for b, n in zip(bits, counts) if b & s) for s in range(1 << m)]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gauss-Jordan elimination in rational numbers; the matrix must be regular."""
    rows = [[*row, r] for row, r in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [row[-1] for row in rows]


def shapley_values(removals: Sequence[int], m: int) -> list[Fraction]:
    """Shares of the filters in what all of them remove, from the removals of all coalitions.

    Stationary point of the weighted squares under the constraint that the shares add up: the normal
    equations with one multiplier.
    """
    normal = [[Fraction(0)] * (m + 1) for _ in range(m + 1)]
    right = [Fraction(0)] * m + [Fraction(removals[-1])]
    for s in range(1, (1 << m) - 1):
        k = s.bit_count()
        weight = Fraction(m - 1, comb(m, k) * k * (m - k))
        inside = [i for i in range(m) if s >> i & 1]
        for i in inside:
            right[i] += weight * removals[s]
            for j in inside:
                normal[i][j] += weight
    for i in range(m):
        normal[i][m] = normal[m][i] = Fraction(1)
    return solved(normal, right)[:m]


def interactions(patterns: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``patterns`` (``part, bits, n, good, toxic``) to one row per part, order of filters and step.

    ``kept`` documents remain after the step and ``removed`` go in it; ``redundant`` fail its filter but
    went earlier; ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` count the marked
    ones among the removed. ``shapley`` is the filter's share times the number of orders, which is a
    whole number: its removals summed over all orders. A part without a row has none here.
    """
    m = len(filters)
    if not 1 <= m <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters, not {m}")
    names, columns = list(filters), [c.split()[0] for c in REPORT.split(", ")]

    def report(rows: pd.DataFrame) -> pd.DataFrame:
        gone = {c: coalition_removals(rows["bits"], rows[c], m) for c in ("n", "good", "toxic")}
        total, every = int(rows["n"].sum()), (1 << m) - 1
        shares = [int(x * factorial(m)) for x in shapley_values(gone["n"], m)]
        out = []
        for order in permutations(range(m)):
            before, label = 0, "".join(names[i] for i in order)
            for step, i in enumerate(order, 1):
                after, own = before | 1 << i, 1 << i
                lost = {c: v[after] - v[before] for c, v in gone.items()}
                alone = gone["n"][every] - gone["n"][every ^ own]
                out.append(
                    (rows["part"].iloc[0], label, step, total - gone["n"][after], lost["n"],
                     gone["n"][own] - lost["n"], alone, lost["good"], lost["toxic"], shares[i])
                )
                before = after
        return pd.DataFrame(out, columns=columns)

    return patterns.groupBy("part").applyInPandas(report, REPORT)


def audit(docs: DataFrame, marks: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """The report over ``failure_patterns``; ``names`` renames its columns ``key``, ``text``, ``part``.

    No document gives no row. Columns beyond the named ones are not read.
    """
    return interactions(failure_patterns(docs, marks, **(names or {})), "ABCDE")
