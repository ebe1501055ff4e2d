import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import toxicity as X


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioubdglmnrst") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    bad = ["zorkface", "quizzle", "xyloscum"]
    texts, marks = [], []
    for i in range(n):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        toxic = i % 3 == 0
        for _ in range(3 if toxic else 0):
            w = rng.choice(bad)
            ws.insert(rng.randrange(len(ws)), w if rng.random() < 0.5 else w + rng.choice("abcdef"))
        texts.append(" ".join(ws).capitalize() + ".")
        marks.append(int(toxic))
    return texts, marks


@pytest.fixture(scope="module")
def model():
    return X.fit(*corpus(300, 1))


def test_learns_and_shares_subwords(model):
    texts, marks = corpus(120, 1)
    p = X.score_texts(model, texts)
    assert np.mean((p >= 0.5) == (np.array(marks) == 1)) > 0.95
    near = X.score_texts(model, ["some words here zorkfacez and more words", "some words here and more words"])
    assert near[0] > near[1]


def plain_score(model, text):
    """Word by word and passage by passage, n-grams hashed one at a time."""
    words, word = [], ""
    for c in text.lower() + " ":
        u = ord(c)
        if u == 0xA0 or u < 128 and not (c.isdigit() or c.isalpha()):
            words, word = words + [word] if word else words, ""
        else:
            word += c
    best = 0.0
    for at in range(0, len(words), X.PASSAGE):
        total, before = 0.0, None
        for w in words[at : at + X.PASSAGE]:
            marked = "\0" + w + "\0"
            pulls = []
            for n in X.GRAMS:
                for i in range(len(marked) - n + 1):
                    h = 0
                    for c in marked[i : i + n]:
                        h = (h * int(X.MULTIPLIER) + ord(c)) % 2**64
                    pulls.append(model.worth[int(X.mixed(np.array([h], np.uint64))[0]) & (X.BUCKETS - 1)])
            if w != before and pulls:
                total += sum(pulls) / len(pulls)
            before = w
        best = max(best, 1 / (1 + np.exp(-total / X.PASSAGE - model.bias)))
    return best


@pytest.mark.parametrize("stretch", [1 << 18, 400, 7])
def test_scores_equal_the_plain_way_however_texts_are_cut(monkeypatch, stretch):
    monkeypatch.setattr(X, "STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    for _ in range(3):  # random worths: every word counts
        model = X.ToxicityModel(rng.normal(0, 3, X.BUCKETS), -1.0)
        texts = [*corpus(6, stretch)[0], "same same same word", "word", "word Ähre, a.b 𝔘𝔘𝔘𝔘", "x" * 900, "a b " * 40]
        found = X.score_texts(model, [*texts, None, "", "...", " "])
        assert found[:-4] == pytest.approx([plain_score(model, t) for t in texts], rel=1e-9)
        assert list(found[-4:]) == [0, 0, 0, 0]


def test_same_input_gives_the_same_model_and_no_labels_give_none():
    texts, marks = corpus(60, 3)
    assert np.array_equal(X.fit(texts, marks, steps=5).worth, X.fit(texts, marks, steps=5).worth)
    assert X.score_texts(X.fit(texts, [0] * 60), texts[:3]).max() < 0.5
    assert X.score_texts(X.fit([], []), ["word"]).max() < 0.5


def test_odd_rows(spark, odd, none, model):
    rows = X.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    left = X.without_toxic(odd, model)
    assert left.columns == odd.columns and 0 < left.count() <= odd.count()
    assert X.score(none, model).count() == 0 and X.without_toxic(none, model).columns == none.columns
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (None, 1), (100, None), (101, 0)], "doc_id long, toxic int")
    found = X.training_rows(odd, labels, lambda k: F.lit(True), {0: 5, 1: 5}, 10_000)
    assert sorted(y for _, y in found.collect()) == [0, 0, 1]
    nothing = X.training_rows(none, labels, lambda k: F.lit(True), {0: 5, 1: 5}, 10_000)
    assert nothing.collect() == [] and X.fit_rows(nothing).bias < 0


def test_long_clean_texts_stay_clean_and_long_texts_with_a_few_insults_do_not():
    texts, marks = corpus(2400, 1)
    clean = [t for t, y in zip(texts, marks) if not y]
    joined = [" ".join(clean[i:1000:40]) for i in range(40)]  # some 2,700 words each

    def insulted(t):
        return t[: len(t) // 2] + " zorkface quizzle xyloscum " + t[len(t) // 2 :]

    sample = [*texts[:600], *joined[10:], *map(insulted, joined[:10])]
    model = X.fit(sample, [*marks[:600], *[0] * 30, *[1] * 10])
    long = [" ".join(clean[1000 + i :: 4]) for i in range(4)]
    assert min(len(t.split()) for t in long) > 15_000
    assert X.score_texts(model, long).max() < 0.5
    assert X.score_texts(model, [insulted(t) for t in long]).min() >= 0.5


def test_training_draws_texts_of_all_lengths(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "word " * (i % 10) * 400) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = X.training_rows(docs, labels, lambda k: F.lit(True), {0: 20, 1: 20}, 1_000_000).collect()
    assert len(rows) == 40 and max(len(t) for t, _ in rows) > 15_000
    few = X.training_rows(docs, labels, lambda k: F.lit(True), {0: 20, 1: 20}, 100_000).collect()
    again = X.training_rows(docs.repartition(5), labels.repartition(3), lambda k: F.lit(True), {0: 20, 1: 20}, 100_000)
    assert sorted(few) == sorted(again.collect())
    assert sum(len(t) for t, _ in few) <= 100_000 and {y for _, y in few} == {0, 1}
    assert max(len(t) for t, _ in few) > 2_500


def test_trained_in_a_task_as_on_one_machine(spark):
    texts, marks = corpus(40, 5)
    df = spark.createDataFrame(list(zip(texts, marks)), "t string, y int").repartition(4)
    there, here = X.fit_rows(df), X.fit(*zip(*sorted(zip(texts, marks))))
    assert np.allclose(there.worth, here.worth) and there.bias == pytest.approx(here.bias)


def test_only_texts_go_to_python(odd, model):
    plan = X.without_toxic(odd, model)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan


def test_sums_take_few_bytes_per_entry():
    """Training holds a sum over every n-gram of every distinct word, in one task of an executor."""
    n = 1 << 20
    source, target = (np.arange(n) * 7919 % 1000).astype(np.int32), (np.arange(n) // 16).astype(np.int32)
    tracemalloc.start()
    sums = X.Sums(source, target, 1000, n // 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    values = np.arange(1000, dtype=np.float32)[:, None]
    assert (sums.forward(values)[:, 0] == values[source, 0].reshape(-1, 16).sum(1)).all()
    assert peak < 28 * n
