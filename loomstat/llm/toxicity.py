"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, begin and end marked, so a misspelt or newly inflected
word shares most vectors with the word it comes from. A passage of 16 words is the average of its
words' embeddings, where an immediate repeat and a missing word count as zero vectors; a softmax over
(clean, toxic) turns the average into the passage's probability.
A document is toxic if any of its passages is, so it scores as its worst passage. A few insults thus
weigh the same in a short and in a very long text, where an average over the whole text would drown
them, and neutral passages add nothing, however many there are. Embeddings and softmax weights are
trained together by Adam on all sampled documents, which are of all lengths: first through the smooth form
``1 - prod(1 - p)``, then through the worst passage itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomstat.llm.tables import map_texts
from loomstat.llm.words import mixed
from loomstat.operators.sampling import bottom_k, key_bucket
from loomstat.session import scratch_path

BUCKETS = 1 << 17
DIM = 4
PASSAGE = 16
GRAMS = (3, 4, 5)
STRETCH = 1 << 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Word characters: everything but white space, controls and ASCII punctuation.
_IS_WORD = np.ones(128, bool)
_IS_WORD[[*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = False


def _chars(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with zeros between words and around texts, and each text's first place."""
    lowered = [t.lower() for t in texts]
    first = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in lowered])])
    u = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.where(u < 128, _IS_WORD[np.minimum(u, 127)], True) & (u != 0xA0)
    return np.where(word, u, 0).astype(np.uint32), first


def _words(text: str) -> list[str]:
    chars = _chars([text])[0]
    return [w for w in chars.tobytes().decode("utf-32-le", "surrogatepass").split("\0") if w]


@dataclass
class Bags:
    """Words and passages of some texts; ``grams`` yields (bucket, word) arrays, a stretch of characters
    and one n-gram length at a time, so that memory beside the texts follows the stretch."""

    chars: np.ndarray
    word_of: np.ndarray
    fresh: np.ndarray
    passage_of_word: np.ndarray
    text_of_passage: np.ndarray

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        more = max(GRAMS) - 1  # an n-gram belongs to the stretch that it starts in
        for start in range(0, len(self.chars), STRETCH):
            chars = self.chars[start : start + STRETCH + more]
            v = chars.astype(np.uint64)
            h = v[:-1] * MULTIPLIER + v[1:]
            inside = chars > 0
            solid = inside[1:-1].copy()
            for n in range(2, max(GRAMS)):  # h holds n characters so far; solid: all but first and last are letters
                h = h[:-1] * MULTIPLIER + v[n:]
                if n + 1 in GRAMS:
                    at = np.flatnonzero(solid[:STRETCH])
                    yield (mixed(h[at]) & np.uint64(BUCKETS - 1)).astype(np.int32), self.word_of[start + at + 1]
                solid = solid[:-1] & inside[n : len(inside) - 1]


def bags(texts: Sequence[str]) -> Bags:
    chars, first = _chars(texts)
    inside = chars > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    word_of = np.cumsum(begins, dtype=np.int32) - 1
    starts = np.flatnonzero(begins)
    n_words = np.diff(np.searchsorted(starts, first))
    passage_of_word, text_of_passage = _passages(n_words)
    fresh = _fresh(passage_of_word, _word_hashes(chars, word_of, starts))
    return Bags(chars, word_of, fresh, passage_of_word, text_of_passage)


def _word_hashes(chars: np.ndarray, word_of: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums, modulo 2**64, of one hash per character and its place in the word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(starts), np.uint64)
    for at in range(0, len(chars), STRETCH):
        inside = np.flatnonzero(chars[at : at + STRETCH]) + at
        word = word_of[inside]
        if len(word):
            hashed = mixed((inside - starts[word]).astype(np.uint64) * MULTIPLIER + chars[inside])
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            total[word[begins]] += np.add.reduceat(hashed, begins)
    return total


def _passages(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's passage and each passage's text, from the texts' numbers of words."""
    n_passages = -(-n_words // PASSAGE)
    passage_start = np.concatenate([[0], np.cumsum(n_passages)])
    words_before = np.concatenate([[0], np.cumsum(n_words)])
    rank = np.arange(n_words.sum()) - np.repeat(words_before[:-1], n_words)
    of_word = np.repeat(passage_start[:-1], n_words) + rank // PASSAGE
    return of_word.astype(np.int32), np.repeat(np.arange(len(n_words), dtype=np.int32), n_passages)


def _fresh(passage_of_word: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """False for a word that repeats the one before it in its passage; equal words have equal kinds."""
    fresh = np.ones(len(passage_of_word), bool)
    fresh[1:] = (passage_of_word[1:] != passage_of_word[:-1]) | (kind[1:] != kind[:-1])
    return fresh


@dataclass
class ToxicityModel:
    """``worth[bucket]`` is an n-gram vector's pull towards toxic, ``bias`` that of an empty bag."""

    worth: np.ndarray
    bias: float

    def score(self, texts: Sequence[str]) -> np.ndarray:
        b = bags(texts)
        n = len(b.passage_of_word)
        pull, count = np.zeros(n), np.zeros(n)
        for bucket, word in b.grams():
            pull += np.bincount(word, self.worth[bucket], n)
            count += np.bincount(word, minlength=n)
        m = len(b.text_of_passage)
        pull /= np.maximum(count, 1)
        mean = np.bincount(b.passage_of_word, pull * b.fresh, m) / PASSAGE
        worst = np.zeros(len(texts))
        np.maximum.at(worst, b.text_of_passage, np.exp(-np.logaddexp(0.0, -mean - self.bias)))
        return worst


class Sums:
    """A sparse 0/1 matrix from sources to targets, by default summing, else averaging."""

    def __init__(self, source: np.ndarray, target: np.ndarray, n_source: int, n_target: int, mean: bool = False):
        self.ways = []
        for key, other, size in ((target, source, n_target), (source, target, n_source)):
            order = np.argsort(key, kind="stable")
            key = key[order]
            begins = np.ones(len(key), bool)
            begins[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(begins)
            self.ways.append((other[order].astype(np.int32, copy=False), key[first], first, size))
            del order, key, begins
        count = np.bincount(target, minlength=n_target)
        self.share = (1.0 / np.maximum(count, 1) if mean else np.ones(n_target)).astype(np.float32)[:, None]

    def _sum(self, values: np.ndarray, way: int) -> np.ndarray:
        other, at, first, size = self.ways[way]
        out = np.zeros((size, values.shape[1]), np.float32)
        for c in range(values.shape[1] if len(at) else 0):  # one column at a time is far faster
            out[at, c] = np.add.reduceat(np.ascontiguousarray(values[:, c])[other], first)
        return out

    def forward(self, values: np.ndarray) -> np.ndarray:
        return self._sum(values, 0) * self.share

    def backward(self, values: np.ndarray) -> np.ndarray:
        return self._sum(values * self.share, 1)


def fit(
    texts: Sequence[str], toxic: Sequence[int], steps: int = 160, rate: float = 0.15, decay: float = 2e-7, seed: int = 7
) -> ToxicityModel:
    """Train vectors and softmax weights on all given texts at once; the same input gives the same model.

    In the first half of the steps a document is toxic by ``1 - prod(1 - p)`` over its passages, which lets
    every passage learn; in the second half by its worst passage, as it is scored, while all passages
    of a clean one are still to be clean.
    """
    rng = np.random.default_rng(seed)
    y = np.asarray(toxic, float)
    if not len(texts) or not 0 < y.sum() < len(y):  # nothing to tell apart
        return ToxicityModel(np.zeros(BUCKETS), 50.0 if len(texts) and y.sum() else -50.0)
    # equal words share their n-grams, which are taken from the distinct words alone
    place: dict[str, int] = {}
    kinds = [np.array([place.setdefault(w, len(place)) for w in _words(t)], np.int32) for t in texts]
    passage_of_word, text_of_passage = _passages(np.array([len(k) for k in kinds]))
    m = len(text_of_passage)
    distinct = sorted(place)
    order = np.empty(len(distinct), np.int32)
    order[[place[w] for w in distinct]] = np.arange(len(distinct))
    kind = order[np.concatenate(kinds)]
    del kinds, place
    buckets, words = (np.concatenate(x) for x in zip(*bags(distinct).grams()))
    used = np.flatnonzero(np.bincount(buckets, minlength=BUCKETS))
    place_of = np.zeros(BUCKETS, np.int32)
    place_of[used] = np.arange(len(used))
    gram = place_of[buckets]
    del buckets
    fresh = _fresh(passage_of_word, kind)
    to_word = Sums(gram, words, len(used), len(distinct), mean=True)
    to_passage = Sums(kind[fresh], passage_of_word[fresh], len(distinct), m)
    del words, gram, kind, passage_of_word, fresh
    some = np.flatnonzero(np.bincount(text_of_passage, minlength=len(y)))  # texts with a word
    starts = np.searchsorted(text_of_passage, some)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    table = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.array([0.0, -6.0])
    state = [np.zeros_like(p) for p in (table, table, soft, soft, bias, bias)]
    for step in range(1, steps + 1):
        passage = to_passage.forward(to_word.forward(table)) / PASSAGE
        logits = passage @ soft + bias
        z = logits[:, 1] - logits[:, 0]
        p = 1 / (1 + np.exp(-z.clip(-60, 60)))
        if 2 * step <= steps:
            clean = np.bincount(text_of_passage, -np.logaddexp(0.0, z), len(y))
            odds = np.exp(clean) / np.maximum(-np.expm1(clean), 1e-12)
            dz = p * np.where(y > 0, -odds * weight, weight)[text_of_passage]
        else:
            highest = np.repeat(np.maximum.reduceat(z, starts), np.diff(np.append(starts, m)))
            toxic_passage = y[text_of_passage] > 0
            dz = np.where(toxic_passage, np.where(z == highest, p - 1, 0.0), p) * weight[text_of_passage]
        back = np.stack([-dz, dz], axis=1)
        d_soft, d_bias = passage.T @ back, back.sum(0)
        d_passage = (back @ soft.T / PASSAGE).astype(np.float32)
        d_table = to_word.backward(to_passage.backward(d_passage)) + np.float32(decay) * table
        for i, (value, grad) in enumerate(((table, d_table), (soft, d_soft), (bias, d_bias))):
            mean, square = state[2 * i], state[2 * i + 1]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    worth = np.zeros(BUCKETS)
    worth[used] = table @ (soft[:, 1] - soft[:, 0])
    return ToxicityModel(worth, float(bias[1] - bias[0]))


def score_texts(model: ToxicityModel, texts: Sequence[str | None]) -> np.ndarray:
    """Scores of any number of texts of any length, some texts at a time; 0 for null and empty.

    What a text scores does not depend on the texts beside it, nor on how long it is.
    """
    worst = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to] or "") <= STRETCH):
            size += len(texts[to] or "")
            to += 1
        worst[at:to] = model.score([t or "" for t in texts[at:to]])
        at = to
    return worst


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    usable: Callable[[str], Column],
    per_class: dict[int, int],
    total_chars: int,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """``t, y``: whole labelled texts of any length, at most ``per_class`` of each label.

    Per class they are those with the smallest hashes of ``key`` among the labelled documents, up to the
    first that no longer fits into the class's share of ``total_chars``; only texts longer than a
    whole share are passed over. A key with several labels counts as toxic if any of them says so, and of
    several texts of one key the least is taken. Null keys, labels and texts are left out. The rows are
    the same in every run; no class is ranked in one task.
    """
    spark = docs.sparkSession
    named = labels.select(F.col(key).alias("i"), F.col(label).cast("int").alias("y"))
    known = named.filter(usable("i") & F.col("i").isNotNull() & F.col("y").isin(0, 1))
    body = docs.select(F.col(key).alias("i"), F.col(text).cast("string").alias("t")).filter(F.col("t").isNotNull())
    there = known.groupBy("i").agg(F.max("y").alias("y")).join(body.select("i"), "i", "left_semi")
    path, texts = scratch_path(spark, "labelled"), scratch_path(spark, "training")
    there.write.parquet(path)
    chosen = bottom_k(spark.read.parquet(path), "i", per_class, by="y", tie=["i"])
    found = body.join(F.broadcast(chosen), "i").groupBy("y", "i").agg(F.min("t").alias("t"))
    found.select("y", "i", "t", key_bucket(F.col("i")).alias("h"), F.length("t").alias("c")).write.parquet(texts)
    rows = spark.read.parquet(texts)  # at most per_class rows
    share = F.when(F.col("y") == 1, total_chars * per_class[1] // sum(per_class.values()))
    share = share.otherwise(total_chars * per_class[0] // sum(per_class.values()))
    sizes = rows.select("y", "i", "h", "c").filter(F.col("c") <= share)
    so_far = F.sum("c").over(Window.partitionBy("y").orderBy("h", "i"))
    fits = sizes.withColumn("sum", so_far).filter(F.col("sum") <= share)
    return rows.join(F.broadcast(fits.select("y", "i")), ["y", "i"], "left_semi").select("t", "y")


def fit_rows(rows: DataFrame) -> ToxicityModel:
    """The model of the rows of ``training_rows``, trained in one task of an executor: the texts never come
    to the driver, only the finished table does."""

    def train(group: pa.Table) -> pa.Table:
        pairs = sorted(zip(group.column("t").to_pylist(), group.column("y").to_pylist()))
        model = fit([t for t, _ in pairs], [y for _, y in pairs])
        return pa.table([pa.array([model.worth.tobytes()], pa.binary()), pa.array([model.bias])], ["worth", "bias"])

    found = rows.groupBy(F.lit(0).alias("one")).applyInArrow(train, "worth binary, bias double").first()
    if found is None:
        return fit([], [])
    return ToxicityModel(np.frombuffer(found["worth"], float), found["bias"])


SCORE = [("score", T.DoubleType())]


def _scorer(docs: DataFrame, model: ToxicityModel) -> Callable[[pa.Array], list]:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return lambda texts: [score_texts(sent.value, texts.to_pylist())]


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the toxicity of the whole text, from 0 to 1, of every row.

    A null or empty text, or one without a word, scores 0. No other column is read.
    """
    scored = map_texts(docs, [F.col(c) for c in keep], F.col(text), SCORE, _scorer(docs, model))
    return scored.toDF(*keep, "score")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, with all their columns; only the texts go to Python."""
    work = _scorer(docs, model)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return pa.array(work(texts)[0])

    return docs.filter(toxicity(F.col(text).cast("string")) < threshold)
