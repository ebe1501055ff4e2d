import random

import numpy as np
from pyspark.sql import functions as F

from loomstat.llm import packing as P


def test_best_fit_is_legal_and_never_worse_than_one_size():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 80))]
        bins, offset, final = P.best_fit(lengths, (16, 32, 64))
        for b, size in enumerate(final):
            own = sorted((offset[i], lengths[i]) for i in np.flatnonzero(bins == b))
            ends = np.cumsum([n for _, n in own])
            assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= size
            assert size == min(c for c in (16, 32, 64) if c >= ends[-1])
        single = P._fit(lengths, [64], P.sequence_cost, "longest")[2]
        assert sum(map(P.sequence_cost, final)) <= sum(map(P.sequence_cost, single))


def test_each_piece_goes_where_it_leaves_least_room():
    bins, _, final = P.best_fit([60, 50, 10, 4], (64,))
    assert bins[3] == bins[0] and bins[2] == bins[1] and final == [64, 64]


def plain_fit(lengths, sizes, cost):
    """Every open sequence looked at for every piece, for each way of opening."""
    best = None
    for way in range(3):
        place, bins = {}, []
        left = sum(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            n = lengths[i]
            room = [(size - sum(lengths[k] for k in own), b) for b, (size, own) in enumerate(bins)]
            room = [r for r in room if r[0] >= n]
            if not room:
                able = [c for c in sizes if c >= n]
                size = [min(able, key=lambda c: (cost(c) / min(c, left), c)), able[0], able[-1]][way]
                room = [(size, len(bins))]
                bins.append((size, []))
            b = min(room)[1]
            place[i] = b, sum(lengths[k] for k in bins[b][1])
            bins[b][1].append(i)
            left -= n
        final = [min((c for c in sizes if c >= sum(lengths[k] for k in own)), key=lambda c: (cost(c), c)) for _, own in bins]
        total = sum(map(cost, final))
        if best is None or total < best[0]:
            best = total, place, final
    return best[1], best[2]


def test_equals_looking_at_every_sequence():
    rng = random.Random(6)
    for sizes in ((16, 32, 64), (10, 100), (7,)):
        for _ in range(60):
            lengths = [rng.randrange(1, sizes[-1] + 1) for _ in range(rng.randrange(1, 50))]
            bins, offset, final = P.best_fit(lengths, sizes)
            place, want = plain_fit(lengths, list(sizes), P.sequence_cost)
            assert [(b, o) for b, o in zip(bins, offset)] == [place[i] for i in range(len(lengths))] and final == want


def test_the_table_is_packed_as_one_machine_would(spark):
    rng = random.Random(2)
    rows = [(i, "g%d" % (i % 3), rng.choice([0, 5, 70, 300])) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, g string, n long").coalesce(1)
    found = P.pack(df, F.col("n"), group=F.col("g"), capacities=(16, 32, 64)).filter("length > 0").collect()
    for g in ("g0", "g1", "g2"):
        cut = [(i, k, min(64, n - 64 * k)) for i, own, n in rows if own == g for k in range(-(-n // 64))]
        cut.sort(key=lambda c: -c[2])
        place, final = plain_fit([c[2] for c in cut], [16, 32, 64], P.sequence_cost)
        want = {(i, k): (f"{g}-{place[at][0]}", final[place[at][0]], place[at][1]) for at, (i, k, _) in enumerate(cut)}
        got = {(r["doc_id"], r["piece"]): (r["bin_id"], r["capacity"], r["offset"]) for r in found if r["bin_id"].startswith(g)}
        assert got == want


def test_cuts_fall_between_tokens(spark, odd, odd_rows):
    from loomstat.llm import tokens
    from loomstat.llm.queries import TOKENIZER, token_length

    enc = tokens.encoding(tokens.Vocabulary.read(TOKENIZER))
    found = P.pack(odd, token_length(spark), capacities=(64, 256)).collect()
    sizes = [len(enc.encode_ordinary(t or "")) for _, t, *_ in odd_rows]
    assert sum(r["length"] for r in found) == sum(sizes)
    assert sum(r["piece"] == 0 for r in found) == len(odd_rows)
    assert P.pack(odd.limit(0), token_length(spark)).collect() == []


def test_odd_rows(odd, none, odd_rows):
    rows = P.pack(odd, F.octet_length("text"), capacities=(128, 512, 1024)).collect()
    assert sum(r["length"] for r in rows) == sum(len((t or "").encode()) for _, t, *_ in odd_rows)
    used = {}
    for r in rows:
        assert (r["bin_id"] is None) == (r["length"] == 0)
        if r["bin_id"] is not None:
            used.setdefault((r["bin_id"], r["capacity"]), []).append((r["offset"], r["length"]))
    for (_, capacity), own in used.items():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= capacity
    assert P.pack(none, F.octet_length("text")).collect() == []
    grouped = P.pack(odd, F.octet_length("text"), group=F.lit("g").cast("string")).filter("length > 0")
    assert grouped.filter("bin_id not like 'g-%'").count() == 0
