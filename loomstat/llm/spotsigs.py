"""Fingerprints of spot signatures: chains of content words that follow common-word anchors.

An anchor is a function word; its signature is the anchor with the next content words (words that
are no anchors) after it. Boilerplate without running text has few anchors, and an edit changes only
the signatures around it. A text's fingerprint is its set of signatures; a text that has words but no
whole chain has one signature, of all its words, and an empty text has none. Two fingerprints are
compared by their Jaccard index. ``near_duplicates`` finds all similar ones: sets are partitioned into
bands of set lengths, so that similar ones are in the same or neighbouring bands, and in a band a set
is compared only with sets that share one of its rarest signatures and whose lengths, places in the
list and parities leave the threshold within reach.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.llm.jaccard import SimilarSets
from loomstat.llm.words import BASE, mixed, run_hash, slices, word_hashes
from loomstat.operators.ordering import with_ordered_chunks, with_row_index

# Frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have in is it of on or that the this to was were which with"
    " aber als am an auf aus bei das dem den der des die ein eine im ist mit nicht sich sind und von zu"
    " au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une"
    " al como con del el ella es lo los las no para pero por se su una y"
).split()
CHAIN = 2


def _anchor_table() -> tuple[np.ndarray, np.ndarray]:
    hashes = np.unique(word_hashes(pa.array(sorted(set(ANCHORS))))[0])
    table = np.zeros(1 << 16, bool)
    table[hashes & np.uint64(0xFFFF)] = True
    return hashes, table


_HASHES, _TABLE = _anchor_table()


def spot_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Signature hashes of all texts and where each text's begin."""
    words, first = word_hashes(texts, lower=True)
    maybe = np.flatnonzero(_TABLE[(words & np.uint64(0xFFFF)).astype(np.int64)])
    anchors = maybe[np.isin(words[maybe], _HASHES)]
    is_content = np.ones(len(words), bool)
    is_content[anchors] = False
    content = np.flatnonzero(is_content)
    start = np.searchsorted(content, anchors)
    doc = np.searchsorted(first, anchors, "right") - 1
    whole = start + CHAIN <= np.searchsorted(content, first[doc + 1])
    start, anchors, doc = start[whole], anchors[whole], doc[whole]
    h = words[anchors]
    for k in range(CHAIN):
        h = mixed(h * np.uint64(BASE) + words[content[start + k]])
    count = np.bincount(doc, minlength=len(first) - 1)
    # texts with words but without a chain: all their words as one signature
    bare = np.flatnonzero((count == 0) & (np.diff(first) > 0))
    if len(bare):
        extra = [run_hash(words[first[d] : first[d + 1]]) for d in bare]
        h, doc = np.concatenate([h, np.array(extra, np.uint64)]), np.concatenate([doc, bare])
        order = np.argsort(doc, kind="stable")
        h, count = h[order], np.bincount(doc, minlength=len(first) - 1)
    return h, np.concatenate([[0], np.cumsum(count)])


def spot_sets(texts: Sequence[str]) -> list[np.ndarray]:
    """Each text's distinct signatures, sorted."""
    values, first = spot_grams(pa.array(texts, pa.string()))
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]


def fingerprint(signatures: np.ndarray) -> str:
    """The set as text: the first six bytes of each sorted signature in base 64."""
    return base64.b64encode(signatures.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()).decode()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard index of two sorted sets; 1 for two empty ones."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``part, last, key, text``: in sorted partitions every row's successor comes next.

    The keys' range is cut into parts of some thousand rows, and a key with many rows is cut again. The
    first row of the next part with rows (after the last part: of the first) is added behind each
    part's own rows, marked ``last``. Null keys come first; repeated keys go by a hash of the text. Keys
    are numbers, dates or times, and the texts are then shuffled once; keys of any other ordered type are
    numbered in their order first, which joins the texts to their keys' numbers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.col("key"))
    if not isinstance(rows.schema["key"].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        numbers = with_row_index(rows.select("key").filter("key is not null").distinct(), [F.col("key")], "place")
        rows = rows.drop("place").join(numbers, "key", "left").select("key", "text", "tie", "place")
    count = docs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 20_000)) if count else 1
    placed = with_ordered_chunks(rows, "place", "tie", parts, "part").drop("place")
    own = F.struct(F.col("key").isNotNull().alias("known"), "key", "tie")
    heads = placed.groupBy("part").agg(F.min(own).alias("head")).collect()
    heads.sort(key=lambda r: r["part"])
    shape = T.StructType([placed.schema["key"], T.StructField("tie", T.LongType()), T.StructField("before", T.LongType())])
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in shape])
    before = [(r["head"]["key"], r["head"]["tie"], heads[i - 1]["part"]) for i, r in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(before, shape).withColumnsRenamed({"key": "hk", "tie": "ht"}))
    known = placed.join(first, F.col("key").eqNullSafe(F.col("hk")) & (F.col("tie") == F.col("ht")), "left")
    here = F.struct(F.col("part").alias("part"), F.lit(0).alias("last"))
    there = F.struct(F.col("before").alias("part"), F.lit(1).alias("last"))
    where = F.explode(F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there)))
    out = known.select(where.alias("at"), "key", "text", "tie").select("at.part", "at.last", "key", "text", "tie")
    order = ["part", "last", F.col("key").asc_nulls_first(), "tie"]
    return out.repartition(parts, "part").sortWithinPartitions(*order).drop("tie")


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit by the next one, and how near they are.

    Every row gives a row ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A null text counts as empty; a single row is its own successor; an
    empty table gives no rows. No other column is read.
    """
    rows = with_next(docs, key, text)
    fields = [rows.schema["key"], T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen: its successor may come with the next batch
        for batch in batches:
            for i, j in slices(batch.column(3)):
                part = batch.slice(i, j - i)
                table = part if held is None else pa.concat_batches([held, part])
                held = table.slice(table.num_rows - 1, 1)
                made = _compare(table, schema)
                if made is not None:
                    yield made

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _compare(table: pa.RecordBatch, schema: T.StructType) -> pa.RecordBatch | None:
    last = np.array(table.column(1))
    own = np.flatnonzero(last[:-1] == 0)
    if not len(own):
        return None
    texts = table.column(3).to_pylist()
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    sets, changed_sets = spot_sets(texts), spot_sets(changed)
    columns = [
        table.column(2).take(pa.array(own)),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        pa.array([fingerprint(sets[i]) for i in own]),
        pa.array([fingerprint(s) for s in changed_sets]),
        pa.array([likeness(sets[i], s) for i, s in zip(own, changed_sets)], pa.float64()),
        pa.array([likeness(sets[i], sets[i + 1]) for i in own], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema.fieldNames())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``(key, n_signatures, component_id)``: classes of fingerprints with this Jaccard index or more.

    ``component_id`` is the least key that can be reached, the own included. Null and empty texts, repeated rows and null keys are treated as in ``jaccard_components``.
    """
    join = SimilarSets(docs, {"rank": F.col(key)}, F.col(text), spot_grams, percent, banded=True, stored=True)
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("rank"))
    return join.components().select(
        F.col("rank").alias(key), F.col("n").alias("n_signatures"), component.alias("component_id")
    )
