import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import jaccard as J
from loomstat.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, size, percent):
    """Component id of every row, all pairs tried."""
    sets = []
    for _, text in rows:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for k in range(i):
            both = len(x & sets[k])
            if x and sets[k] and 100 * both >= percent * (len(x) + len(sets[k]) - both):
                root[find(i)] = find(k)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    out, common = [], [f"c{i}" for i in range(40)]
    for family in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([2, 12, 60, 150]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9000)}"
            if rng.random() < 0.2:
                copy = copy + common
            out.append(" ".join(copy).title() if rng.random() < 0.1 else " ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed, size, percent, list_rows", [(1, 3, 90, 100_000), (2, 5, 80, 100_000), (3, 3, 80, 3)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, size, percent, list_rows):
    monkeypatch.setattr(J, "LIST_ROWS", list_rows)  # 3: every list is cut into parts
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = J.jaccard_components(docs, size=size, percent=percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, size, percent)


def test_chain_of_near_copies_is_one_component(spark):
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(30):  # each differs from the next a little, the ends from each other a lot
        base[4 * i] = f"e{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in J.jaccard_components(docs).collect()), key=str) == plain(rows, 3, 90)


@pytest.mark.parametrize("list_rows", [100_000, 40])
def test_rows_just_below_the_threshold_are_not_multiplied(spark, monkeypatch, list_rows):
    monkeypatch.setattr(J, "LIST_ROWS", list_rows)
    common, met = [f"c{i}" for i in range(952)], []
    rows = [(i, " ".join(common + [f"r{i}x{k}" for k in range(60 + i % 3)])) for i in range(240)]
    rows.append((500, rows[7][1] + " more"))  # and one near copy
    exact = J.SimilarSets._exact

    def counted(self, pairs):
        met.append(pairs.count())
        return exact(self, pairs)

    monkeypatch.setattr(J.SimilarSets, "_exact", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs).collect()}
    assert found == {**{i: i for i in range(240)}, 500: 7}
    assert sum(met) <= 2 * len(rows)  # all pairs: 28,920


def test_only_columns_that_stand_out_are_cut(monkeypatch):
    monkeypatch.setattr(J, "LIST_ROWS", 100)
    counts = np.full(1000, 5_000) + np.arange(1000) % 50
    counts[7] += 950
    parts = J.list_parts(counts, float(np.median(counts)))
    assert parts[7] == 10 and np.delete(parts, 7).max() == 1


def test_odd_rows(odd, none, odd_rows):
    found = J.jaccard_components(odd).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain([r[:2] for r in odd_rows], 3, 90)
    assert J.jaccard_components(none).collect() == []


def test_one_of_each_keeps_one_row_a_group(odd, none):
    left = J.one_of_each(odd, size=5, percent=80)
    assert left.columns == odd.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(7) == 1 and 8 not in ids and 9 not in ids
    assert ids.count(12) == 2 and {1, 2, 3} <= set(ids)
    assert J.one_of_each(none).columns == none.columns and J.one_of_each(none).count() == 0
    twice = J.one_of_each(odd.union(odd), size=5, percent=80)
    assert twice.filter("doc_id >= 100").count() == 40
    assert twice.filter(F.col("doc_id").isNull() & F.col("text").isNotNull()).count() == 1


def test_components_of_links(spark):
    links = [(1, 2), (2, 3), (5, 4), (6, 6), (7, 3), (2, 1), (9, 8), (8, 5)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {2: 1, 3: 1, 7: 1, 5: 4, 8: 4, 9: 4}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
    path = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r["v"] for r in components(path).collect()} == {0}


def test_the_bitmap_holds_every_name(spark):
    names = spark.createDataFrame([(a,) for a in (0, 1, -1, 63, 64, -(2**63), 2**63 - 1, J.BITMAP_BITS, 12345678901)], "a long")
    bits = J._bitmap(names)
    for r in names.collect():
        place = r["a"] % J.BITMAP_BITS
        assert int(bits[place >> 6]) >> (place & 63) & 1
    assert sum(int(b).bit_count() for b in bits) == len({r["a"] % J.BITMAP_BITS for r in names.collect()})
