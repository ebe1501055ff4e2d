import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomstat.llm import langid
from loomstat.llm.words import pieces, text_buffer

TRAIN = [("en", "the cat sat on the mat"), ("en", "this is that thing"), ("de", "der hund und die größe"), ("de", "das ist ein haus")]


def plain_bits(lang, text):
    """Code length byte by byte, from counts kept in dictionaries."""
    counts = defaultdict(lambda: defaultdict(int))
    for name, t in TRAIN:
        b = b"\n\n\n" + t.encode()
        for i in range(3, len(b)) if name == lang else ():
            for k in range(4):
                counts[b[i - k : i]][b[i]] += 1
    total, b = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(b)):
        gone = set()
        for k in (3, 2, 1, 0):
            c = {s: n for s, n in counts.get(b[i - k : i], {}).items() if s not in gone}
            if c:
                n, kinds = sum(c.values()), len(c)
                if b[i] in c:
                    total -= math.log2(c[b[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
                gone |= set(c)
        else:
            total += math.log2(256 - len(gone))
    return total


@pytest.mark.parametrize("size", [1 << 20, 5])
def test_lengths_are_those_of_ppm(monkeypatch, size):
    monkeypatch.setattr(pieces, "__defaults__", (size,))
    model = langid.fit(TRAIN)
    texts = ["the größe hat", "", "zzq 一 the", "a", "der hund sat on that", "th"]
    bits = model.lengths(*text_buffer(pa.array(texts)))
    for row, text in zip(bits, texts):
        for lang, found in zip(model.languages, row):
            assert found == pytest.approx(plain_bits(lang, text), rel=1e-5)


def test_probabilities_sum_to_one():
    model = langid.fit(TRAIN)
    p = np.exp2(-model.bits.astype(float))
    assert np.allclose(p[:, :-1].sum(1) + p[:, -1] * (257 - model.size), 1)


def test_odd_rows(odd, none):
    rows = langid.identify(odd, langid.fit(TRAIN)).collect()
    assert len(rows) == odd.count()
    assert all(r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert langid.identify(none, langid.fit(TRAIN)).collect() == []
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit([])).collect()} == {"und"}


def test_training_rows_are_bounded_and_known(odd, none):
    texts = langid.training_texts(odd, F.lit(True), "text", "lang", "doc_id", per_language=3, max_chars=1000)
    assert 0 < len(texts) <= 3 * 4 and all(lang and t and len(t) <= 1000 for lang, t in texts)
    assert langid.training_texts(none, F.lit(True), "text", "lang", "doc_id", 3, 10) == []


def test_a_language_of_long_texts_is_learned_and_every_run_sees_the_same(spark):
    rows = [(i, "word and tree " * (2 if i % 2 else 900), "en" if i % 2 else "fr") for i in range(40)] + [(3, "again", "en")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = langid.training_texts(docs, F.lit(True), "text", "lang", "doc_id", 15, 1000)
    assert [sum(x == lang for x, _ in first) for lang in ("en", "fr")] == [15, 15]
    assert {len(t) for lang, t in first if lang == "fr"} == {1000}
    assert len({t[:20] for lang, t in first if lang == "fr"}) > 1  # not the texts' beginnings alone
    again = langid.training_texts(docs.repartition(7, "text"), F.lit(True), "text", "lang", "doc_id", 15, 1000)
    assert first == again


def test_held_out_accuracy(spark):
    from loomstat.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op2_language"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = rows.filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.9 * len(held)
    random.seed(0)
