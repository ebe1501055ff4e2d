import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from loomstat.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, marks):
    """Every order walked through document by document."""
    texts = [(t or "", k) for k, t, _ in rows]
    docs = []
    for k, t, lang in rows:
        t = t or ""
        ws = WORD.findall(t)
        fails = {
            "A": len(ws) < 200,
            "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": k is not None and any(u == t and j is not None and j < k for u, j in texts),
        }
        good = any(m[0] == k and m[1] == 1 for m in marks if k is not None)
        toxic = any(m[0] == k and m[2] == 1 for m in marks if k is not None)
        docs.append((lang or "", fails, good, toxic))
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                earlier = sum(d[1][f] for d in own) - len(gone)
                left = [d for d in left if not d[1][f]]
                only = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                total[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), earlier, only, sum(d[2] for d in gone), sum(d[3] for d in gone)
                )
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_report_equals_walking_through_every_order(spark, odd, odd_rows):
    rng = random.Random(3)
    texts = ["Some WORDS here", "A#b " * 30, " ".join(f"v{i}" for i in range(250)), "x " * 300, "", "a\x0bB\x1fc"]
    more = [(500 + i % 70, rng.choice(texts) + " tail" * rng.randrange(2), rng.choice(["en", "de", "", None])) for i in range(150)]
    rows = [r[:3] for r in odd_rows] + more
    docs = odd.select("doc_id", "text", "lang", F.lit(1).alias("part"), F.lit(2).alias("n"), F.lit(3).alias("_key")).unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True
    )
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, 5])) for i in [*range(1, 14), *range(500, 600), 505, 506]]
    marks += [(None, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert found(audit.audit(docs, table)) == plain(rows, marks)


def test_no_documents_and_no_marks(spark, none, odd):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, marks).collect() == []
    rows = audit.audit(odd, marks).collect()
    assert len(rows) == 600 * odd.select(F.coalesce("lang", F.lit(""))).distinct().count()
    assert not any(r["good_lost"] or r["toxic_lost"] for r in rows)


@pytest.mark.parametrize("m", [1, 2, 3, 6])
def test_shares_are_averages_over_all_orders(m):
    rng = random.Random(m)
    bits, counts = list(range(1 << m)), [rng.randrange(10**15) for _ in range(1 << m)]
    v = audit.coalition_removals(bits, counts, m)
    sums, orders = [0] * m, list(permutations(range(m)))
    for order in orders:
        before = 0
        for i in order:
            sums[i] += v[before | 1 << i] - v[before]
            before |= 1 << i
    assert audit.shapley_values(v, m) == [Fraction(s, len(orders)) for s in sums]


def test_other_filters(spark):
    rows = [("p", 1, 4, 0, 0), ("p", 3, 2, 0, 1), ("p", 0, 9, 0, 0)]
    got = found(audit.interactions(spark.createDataFrame(rows, "part string, bits long, n long, good long, toxic long"), ["x", "y"]))
    assert got["p", "xy", 1] == (9, 6, 0, 4, 0, 1, 10) and got["p", "yx", 2] == (9, 4, 2, 4, 0, 0, 10)
    with pytest.raises(ValueError):
        audit.interactions(None, "abcdefgh")
