"""Language of a text by prediction by partial matching over bytes.

``fit`` counts, for each language, which byte follows which context of 0 to 3 bytes. A byte's code
length under a language is that of PPM with escape method C and full exclusion: from the longest
context down, a seen byte costs ``-log2(count / (total + kinds))``, an unseen one the escape
``-log2(kinds / (total + kinds))`` and then its cost one context shorter, where bytes seen above are
left out; bytes never seen share what remains of the 256 evenly. The statistics are frozen after
``fit``, so all code lengths are tabulated once and a text's exact length is a sum of table cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.llm.tables import map_texts
from loomstat.llm.words import pieces, text_buffer
from loomstat.operators.sampling import bottom_k, key_bucket
from loomstat.session import scratch_path

ORDER = 3
START = 10  # a text begins as after line ends


@dataclass
class PpmModel:
    """``bits[row, symbol]`` is a code length per language; ``row_of`` gives the row of a context."""

    languages: list[str]
    symbol: np.ndarray
    row_of: np.ndarray
    bits: np.ndarray

    @property
    def size(self) -> int:
        return self.bits.shape[1]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of every document (rows) under every language (columns)."""
        n, a = len(offsets) - 1, self.size
        out = np.zeros((n, len(self.languages)))
        flat = self.bits.reshape(-1, len(self.languages))
        start_symbol = int(self.symbol[START])
        for start, end in pieces(data, offsets):
            from_doc = np.searchsorted(offsets, start, "right") - 1
            to_doc = np.searchsorted(offsets, end, "left")
            back = min(ORDER, int(start - offsets[from_doc]))
            s = self.symbol[data[start - back : end]].astype(np.int32)
            s = np.concatenate([np.full(ORDER - back, start_symbol, np.int32), s])
            context = (s[:-3] * a + s[1:-2]) * a + s[2:-1]
            cuts = (offsets[from_doc:to_doc] - start).clip(0)
            begins = cuts[np.concatenate([[True], offsets[from_doc + 1 : to_doc] < end])]
            last = end - start
            for at in range(ORDER):  # the first bytes of a document see no byte of the one before
                own = offsets[from_doc:to_doc] + at
                own = own[(own >= start) & (own < end) & (own < offsets[from_doc + 1 : to_doc + 1])] - start
                padded = [s[own + ORDER - k] if k <= at else start_symbol for k in (3, 2, 1)]
                context[own] = (padded[0] * a + padded[1]) * a + padded[2]
            cost = flat[self.row_of[context] * a + s[3:]]
            full = np.flatnonzero(np.diff(np.append(begins, last)) > 0)
            if len(full):
                sums = np.add.reduceat(cost, begins[full], axis=0, dtype=np.float64)
                out[from_doc + full] += sums
        return out


def _exclusive_bits(levels: Sequence[tuple[np.ndarray, np.ndarray | None]], unseen: int) -> np.ndarray:
    """Code lengths for contexts given by counts from the longest to the empty context.

    Each level is a pair (counts of contexts x symbols, row of each context in it or None for all).
    """
    first = levels[0][0]
    bits = np.zeros(first.shape)
    open_cells = np.ones(first.shape, bool)
    paid = np.zeros(len(first))
    for counts, rows in levels:
        own = (counts if rows is None else counts[rows]) * open_cells
        total, kinds = own.sum(1), (own > 0).sum(1)
        all_of_it = np.maximum(total + kinds, 1)[:, None]
        hit = own > 0
        cost = paid[:, None] - np.log2(np.where(hit, own, 1) / all_of_it)
        bits[hit] = cost[hit]
        open_cells &= ~hit
        paid += np.where(kinds > 0, np.log2(np.maximum(total + kinds, 1) / np.maximum(kinds, 1)), 0.0)
    # the last symbol stands for each of the ``unseen`` byte values that occur in no language
    left = open_cells[:, :-1].sum(1) + unseen
    rest = (paid + np.log2(np.maximum(left, 1)))[:, None]
    return np.where(open_cells, rest, bits)


def fit(texts: Sequence[tuple[str, str]]) -> PpmModel:
    """Count the contexts of (language, text) pairs and tabulate all code lengths."""
    languages = sorted({lang for lang, _ in texts})
    lead = bytes([START]) * ORDER
    own = {lang: [t.encode() for x, t in texts if x == lang] for lang in languages}
    joined = {lang: np.frombuffer(b"".join(lead + t for t in own[lang]), np.uint8) for lang in languages}
    seen = np.unique(np.concatenate([np.array([START], np.uint8), *joined.values()]))
    a = len(seen) + 1
    symbol = np.full(256, a - 1, np.uint8)
    symbol[seen] = np.arange(len(seen), dtype=np.uint8)
    grams = {}
    for lang, data in joined.items():
        s = symbol[data].astype(np.int64)
        coded = ((s[:-3] * a + s[1:-2]) * a + s[2:-1]) * a + s[3:]
        ends = np.cumsum([ORDER + len(t) for t in own[lang]])
        counted = np.ones(len(coded), bool)  # a text's last bytes do not lead to the next one's start
        for k in range(ORDER):
            counted[ends[:-1] - ORDER + k] = False
        codes, counts = np.unique(coded[counted], return_counts=True)
        grams[lang] = codes, counts
    contexts = np.unique(np.concatenate([codes // a for codes, _ in grams.values()] or [np.zeros(0, int)]))
    pairs = np.arange(a * a)
    tables = []
    for lang in languages:
        codes, counts = grams[lang]
        third = np.zeros((len(contexts), a), np.float32)
        third[np.searchsorted(contexts, codes // a), codes % a] = counts
        second = np.bincount(codes % a**3, counts, a**3).reshape(a * a, a)
        first = second.reshape(a, a, a).sum(0)
        none = first.sum(0, keepdims=True)
        short = [(first, pairs % a), (none, np.zeros(a * a, int))]
        two = _exclusive_bits([(second, None), *short], 256 - len(seen))
        tail = contexts % (a * a)
        low = [(second, tail), (first, tail % a), (none, np.zeros(len(contexts), int))]
        three = _exclusive_bits([(third, None), *low], 256 - len(seen))
        tables.append(np.concatenate([two, three]).astype(np.float32))
    row_of = np.tile(pairs.astype(np.int32), a)
    row_of[contexts] = a * a + np.arange(len(contexts), dtype=np.int32)
    return PpmModel(languages, symbol, row_of, np.stack(tables, axis=-1) if tables else np.zeros((0, a, 0)))


def training_texts(
    docs: DataFrame, usable: Column, text: str, lang: str, key: str, per_language: int, max_chars: int
) -> list[tuple[str, str]]:
    """``per_language`` lower-cased texts of each language, of any length (fewer where there are fewer).

    They are the usable, non-empty texts with the smallest hashes of ``key``, of several texts of one key
    the least. A text of more than ``max_chars`` characters gives a stretch of that length, from a place
    that its hash chooses, so the sample is bounded and no length is left out. The same rows are
    taken in every run, and no language is ranked in one task.
    """
    spark = docs.sparkSession
    known = usable & F.col(lang).isNotNull() & F.col(key).isNotNull() & (F.col(text) != "")
    named = docs.filter(known).select(F.col(lang).alias("l"), F.col(key).alias("i"), F.col(text).cast("string").alias("t"))
    path = scratch_path(spark, "languages")
    named.select("l", "i").distinct().write.parquet(path)
    chosen = bottom_k(spark.read.parquet(path), "i", per_language, by="l", tie=["i"])
    found = named.join(F.broadcast(chosen), ["l", "i"]).groupBy("l", "i").agg(F.min("t").alias("t"))
    place = F.pmod(key_bucket(F.col("i")), F.greatest(F.length("t") - max_chars, F.lit(0)) + 1) + 1
    stretch = F.lower(F.substring("t", place.cast("int"), F.lit(max_chars)))
    return sorted((r["l"], r["t"]) for r in found.select("l", stretch.alias("t")).collect())


def identify(docs: DataFrame, model: PpmModel, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the language of the shortest code and its probability among the languages.

    A null text, or one without a letter, gives ``und`` and score 0; so does a model without
    languages. Equal code lengths go to the language first in order. Texts are lower-cased first.
    Every row gives one row, whatever it repeats; no other column is read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    body = F.when(F.col(text).rlike(r"\p{L}"), F.lower(F.col(text)))

    def score(texts: pa.Array) -> list:
        ppm = sent.value
        names = np.array([*ppm.languages, "und"], object)
        best, share = np.full(len(texts), -1), np.zeros(len(texts))
        if len(ppm.languages):
            bits = ppm.lengths(*text_buffer(texts))
            gap = bits - bits.min(1, keepdims=True)
            some = ~np.array(texts.is_null())
            best[some] = bits.argmin(1)[some]
            share[some] = 1.0 / np.exp2(-np.minimum(gap, 1000.0)).sum(1)[some]
        return [pa.array(names[best], pa.string()), share]

    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType())]
    found = map_texts(docs, [F.col(c) for c in keep], body, fields, score)
    return found.toDF(*keep, "lang_pred", "score")
