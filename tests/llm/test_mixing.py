import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loomstat.llm import mixing as M


@pytest.mark.parametrize("parts", [[1], [1, 1], [3, 2, 7], [1, 99, 400, 500], [5, 5, 5, 1]])
def test_every_block_is_between_release_and_deadline(parts):
    total, slots = sum(parts), M.period(parts)
    assert sorted(t for s in slots for t in s) == list(range(total))
    for p, own in zip(parts, slots):
        for k, t in enumerate(own):
            assert k * total // p <= t < -(-(k + 1) * total // p)
        for t in range(total + 1):
            assert abs(sum(x < t for x in own) - Fraction(t * p, total)) < 1


def test_whole_schedule_equals_one_made_slot_by_slot():
    parts, blocks = [5, 3, 2], [4, 30, 7]
    line = {}
    for i, a, b, start, p, cycle, slots in M.phases(parts, blocks):
        for k in range(b - a):
            t = start + k // p * cycle + slots[k % p]
            assert t not in line
            line[t] = i
    assert sorted(line) == list(range(sum(blocks))) and Counter(line.values()) == {0: 4, 1: 30, 2: 7}
    seen, phase, left = Counter(), 0, {0, 1, 2}
    for t in range(sum(blocks)):  # restart whenever a source has run out
        seen[line[t]] += 1
        share = {i: Fraction(parts[i], sum(parts[k] for k in left)) for i in left}
        assert all(abs(seen[i] - (t + 1 - phase) * share[i]) < 1 for i in left)
        done = Counter(line[x] for x in range(t + 1))
        if any(done[i] == blocks[i] for i in left):
            left = {i for i in left if done[i] < blocks[i]}
            seen, phase = Counter(), t + 1


def test_all_rows_in_whole_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)
    docs = spark.range(1000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' when id % 100 < 3 then null else 's' || id % 7 end as source")
    rows = M.mix(docs, block_rows=4).select("row.*", "slot", "place", "position").collect()
    assert len(rows) == 1000 and len({r["position"] for r in rows}) == 1000 and len({r["doc_id"] for r in rows}) == 1000
    of = {}
    for r in rows:
        assert of.setdefault(r["slot"], r["source"]) == r["source"]
    assert sorted(of) == list(range(len(of)))
    again = M.mix(docs.repartition(7), block_rows=4).select("row.doc_id", "position").collect()
    assert {(r["doc_id"], r["position"]) for r in again} == {(r["doc_id"], r["position"]) for r in rows}


def test_a_bucket_filled_by_one_key_is_cut(spark, monkeypatch):
    sizes = []
    cells = M._cells

    def seen(rows):
        cut, counts = cells(rows)
        sizes.append(max(r["c"] for r in counts.collect()))
        return cut, counts

    key = "case when id % 3 = 0 then null when id % 3 = 1 then 5 else id end as doc_id"
    docs = spark.range(3_000).selectExpr(key, "case when id < 2700 then 'hot' else 's' || id % 2 end as source", "if(id % 3 = 1, id, 0) as extra")
    plain = [tuple(r) for r in M.mix(docs, row=F.struct("*")).orderBy("position").select("row.*", "position").collect()]
    monkeypatch.setattr(M, "BUCKET_ROWS", 10)
    monkeypatch.setattr(M, "_cells", seen)
    for rows in (docs, docs.repartition(5)):
        assert [tuple(r) for r in M.mix(rows, row=F.struct("*")).orderBy("position").select("row.*", "position").collect()] == plain
    assert len({p for *_, p in plain}) == 3_000 and max(sizes) <= M.HEAVY * 10


def test_named_weights_and_odd_rows(odd, none):
    rows = M.mix(odd, weights={"a": 3, "b": 1}, block_rows=1).select("row.source", "position").orderBy("position").collect()
    assert len(rows) == odd.count()
    head = Counter(r["source"] for r in rows[:16])
    assert abs(head["a"] - 12) < 1.01 and head["a"] + head["b"] == 16
    rest = [r["source"] for r in rows if r["source"] not in ("a", "b")]
    assert [r["source"] for r in rows[-len(rest) :]] == rest  # no weight: after the others
    assert M.mix(none).collect() == []


def test_line_equals_phases():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 9)
        parts, blocks = [rng.randrange(1, 7) for _ in range(n)], [rng.randrange(0, 30) for _ in range(n)]
        found = {}
        for i, a, b, start, p, cycle, slots in M.phases(parts, blocks):
            found |= {start + (k - a) // p * cycle + slots[(k - a) % p]: (i, k) for k in range(a, b)}
        assert list(M.line(parts, blocks)) == [found[t] for t in range(sum(blocks))]


def test_thousands_of_sources_keep_all_rows_and_the_same_order(spark, monkeypatch):
    docs = spark.range(6_000).selectExpr("id as doc_id", "'s' || id % 3000 as source")
    rows = M.mix(docs, block_rows=1, resolution=1000).select("row.*", "position").collect()
    assert len(rows) == 6_000 and sorted(r["position"] for r in rows) == list(range(6_000))
    few = spark.range(900).selectExpr("id as doc_id", "case when id % 3 = 0 then null else 's' || id % 7 end as source")
    weights = {"s1": 5, "s2": 1, None: 3}
    plain = {tuple(r) for r in M.mix(few, weights=weights, block_rows=4).select("row.doc_id", "position").collect()}
    monkeypatch.setattr(M, "MAX_CELLS", 1)
    monkeypatch.setattr(M, "LINE_ROWS", 7)
    assert plain == {tuple(r) for r in M.mix(few, weights=weights, block_rows=4).select("row.doc_id", "position").collect()}


def test_a_large_source_keeps_its_weight_beside_thousands_of_small_ones(spark):
    docs = spark.range(6_000).selectExpr("id as doc_id", "case when id < 2000 then 'hot' else 's' || id % 2000 end as source")
    weights = {"hot": 1000.0} | {f"s{i}": 1.0 for i in range(2000)}
    rows = M.mix(docs, weights=weights, block_rows=1).select("row.source", "position").collect()
    head = [r["source"] for r in rows if r["position"] < 600]
    assert len(rows) == 6_000 and len(head) == 600 and abs(head.count("hot") - 200) <= 1
