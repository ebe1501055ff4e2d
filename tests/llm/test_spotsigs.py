import hashlib
import random
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loomstat.llm import jaccard as J
from loomstat.llm import spotsigs as S
from loomstat.llm import words as W


def plain_set(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    out = set()
    for i, w in enumerate(ws):
        if w in S.ANCHORS:
            tail = list(islice((x for x in islice(ws, i + 1, None) if x not in S.ANCHORS), S.CHAIN))
            if len(tail) == S.CHAIN:
                out.add((w, *tail))
    return out or ({tuple(ws)} if ws else set())


def plain_likeness(x, y):
    return len(x & y) / len(x | y) if x and y else float(not x and not y)


def test_signatures_equal_the_plain_way():
    rng = random.Random(8)
    texts = ["", "the", "The cat", "the cat sat", "no anchor words", "is of the"]
    texts += [" ".join(rng.choice(["the", "of", "Is", "cat", "dog", "sun", "sky"]) for _ in range(rng.randrange(60))) for _ in range(50)]
    sets, plain = S.spot_sets(texts), [plain_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(len(texts)):
        for k in range(i):
            assert S.likeness(sets[i], sets[k]) == plain_likeness(plain[i], plain[k])
            assert (S.fingerprint(sets[i]) == S.fingerprint(sets[k])) == (plain[i] == plain[k])


def test_odd_rows_follow_the_next_document(odd, none, odd_rows):
    rows = S.compared(odd.filter("doc_id is not null and doc_id not in (8, 12)")).collect()
    docs = sorted((d, t or "") for d, t, *_ in odd_rows if d not in (None, 8, 12))
    assert len(rows) == len(docs)
    found = {r["doc_id"]: r for r in rows}
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = found[d]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        if len(text) < 2000:
            assert r["near_edited"] == plain_likeness(plain_set(text), plain_set(changed))
            assert r["near_next"] == plain_likeness(plain_set(text), plain_set(following))
    assert len(S.compared(odd).collect()) == len(odd_rows)
    assert S.compared(none).collect() == []
    alone = S.compared(odd.filter("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_keys_of_any_order_and_one_key_with_most_rows(spark, odd_rows):
    named = [(f"k{d:05}" if d is not None else None, t) for d, t, *_ in odd_rows if d not in (8, 12)]
    named = [r for i, r in enumerate(named) if r[0] is not None or named[i - 1][0] is not None]  # one null
    rows = S.compared(spark.createDataFrame(named, "doc_id string, text string").repartition(3)).collect()
    docs = sorted(((d, t or "") for d, t in named), key=lambda r: (r[0] is not None, r[0] or ""))
    found = {r["doc_id"]: r["edited_sha256"] for r in rows}
    assert len(rows) == len(docs)
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        assert found[d] == hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()
    many = spark.range(60_000).select(F.lit(5).alias("doc_id"), F.concat(F.lit("the "), F.col("id").cast("string")).alias("text"))
    parts = S.with_next(many, "doc_id", "text").groupBy("part").agg(F.count_if(F.col("last") == 0).alias("n")).collect()
    assert len(parts) >= 3 and sum(r["n"] for r in parts) == 60_000 and max(r["n"] for r in parts) < 35_000


def test_near_duplicates_by_fingerprint(spark, odd, none):
    rng = random.Random(9)
    base = [rng.choice(["the", "of", "is"]) if i % 3 == 0 else f"w{rng.randrange(500)}" for i in range(300)]
    rows = []
    for i in range(8):
        copy = list(base)
        copy[10 * i + 1] = f"e{i}"
        rows.append((i, " ".join(copy)))
    rows.append((50, " ".join(f"z{i} the" for i in range(100))))
    found = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: plain_set(t) for i, t in rows}
    assert all(plain_likeness(sets[0], sets[i]) >= 0.8 for i in range(8))
    assert found == {**{i: 0 for i in range(8)}, 50: 50}
    assert S.near_duplicates(odd).count() == odd.count() and S.near_duplicates(none).count() == 0
    assert S.near_duplicates(odd).filter(F.col("doc_id") == 8).first()["component_id"] == 7


def test_classes_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(10)
    rows = []
    for _ in range(14):
        base = [rng.choice(["the", "of", "is"]) if rng.random() < 0.3 else f"w{rng.randrange(900)}" for _ in range(rng.choice([4, 30, 90, 300]))]
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9000)}"
            if rng.random() < 0.4:  # longer sets, over the edges of the bands
                copy += ["the", *[f"t{rng.randrange(50)}" for _ in range(len(copy) // 9)], "of", "some", "more"]
            rows.append(" ".join(copy))
    rows = list(enumerate(rows)) + [(900, None), (901, "")]
    sets = [plain_set(t or "") for _, t in rows]
    home = list(range(len(rows)))
    for i, x in enumerate(sets):
        for k in range(i):
            if x and sets[k] and plain_likeness(x, sets[k]) >= 0.8 and home[i] != home[k]:
                low, high = sorted((home[i], home[k]))
                home = [low if h == high else h for h in home]
    wish = {rows[i][0]: (len(sets[i]), rows[h][0]) for i, h in enumerate(home)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for list_rows in (100_000, 3):
        monkeypatch.setattr(J, "LIST_ROWS", list_rows)
        found = {r["doc_id"]: (r["n_signatures"], r["component_id"]) for r in S.near_duplicates(docs).collect()}
        assert found == wish


def test_similar_lengths_are_in_neighbouring_bands():
    for percent in (51, 80, 90, 99, 100):
        band = J.length_bands(np.arange(1, 3000), percent)
        for n in range(1, 1500):
            far = min(n * 100 // percent, 2999)
            assert band[far - 1] - band[n - 1] in (0, 1)


def test_whole_texts_as_signatures_take_no_array_step_per_word(monkeypatch):
    rng = random.Random(11)
    steps = []
    monkeypatch.setattr(W, "mixed", lambda h, plain=W.mixed: steps.append(1) or plain(h))
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(n)) for n in (3000, 1, 0, 7, 2000)]
    values, first = S.spot_grams(pa.array(texts))
    assert list(np.diff(first)) == [1, 1, 0, 1, 1] and len(steps) < 100
    monkeypatch.setattr(W, "RUN_WORDS", 64)
    wish = [W.shingle_hashes(*W.word_hashes(pa.array([t])), len(t.split()))[0][0] for t in texts if t]
    assert list(values) == wish and list(S.spot_grams(pa.array(texts))[0]) == wish


def test_the_texts_of_the_classes_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda t: read.add(1) or t, "string").asNondeterministic()
    base = " ".join(f"the w{i} v{i}" for i in range(40))
    rows = [(3, base), (5, base + " the end of"), (6, base), (7, "no chain"), (8, "No chain"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", counted("text").alias("text"))
    found = S.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {3: 3, 5: 3, 6: 3, 7: 7, 8: 7, 9: 9}
    assert read.value == len(rows)
