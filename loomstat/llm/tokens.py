"""Token counts that follow edits: a tree of sums over runs of whole pre-tokens.

Byte-level BPE first splits a text into pre-tokens and encodes each by itself. White space never
follows another character within a pre-token, and the split runs from left to right without looking
back, so a text may be cut before white space that follows a visible character, and the counts of the
parts add up to the count of the whole. A leaf is such a run of pre-tokens; inner nodes hold sums. An
edit replaces characters: the leaves it touches, and the neighbour where it reaches a leaf's edge,
are joined, encoded again and put in the place of the old ones, and only the sums above them change.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_CHARS = 512

# Fixed value: the pre-token pattern that this family of vocabularies is made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Vocabulary:
    """Merge ranks, read once on the driver and sent to the tasks."""

    name: str
    ranks: dict[bytes, int] = field(hash=False, repr=False)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls(path, {base64.b64decode(token): int(rank) for token, rank in pairs})


_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(vocabulary: Vocabulary) -> tiktoken.Encoding:
    """The encoder, built once per Python worker."""
    if vocabulary.name not in _encodings:
        _encodings[vocabulary.name] = tiktoken.Encoding(
            vocabulary.name, pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
        )
    return _encodings[vocabulary.name]


def leaves(text: str, size: int = LEAF_CHARS) -> list[int]:
    """Lengths of runs of at least ``size`` characters, cut before white space after a visible character."""
    out, at = [], 0
    while at < len(text):
        to = at + size
        while to < len(text) and not (text[to] in " \t\n\r" and not text[to - 1].isspace()):
            to += 1
        to = min(to, len(text))
        out.append(to - at)
        at = to
    return out


class TokenTree:
    """Leaf lengths and counts of one text, with sums of both in a binary tree above them."""

    def __init__(self, lengths: Sequence[int], counts: Sequence[int]):
        self.load(list(lengths), list(counts))

    def load(self, lengths: list[int], counts: list[int]) -> None:
        """Set the leaves; the tree's leaf level is the next power of two."""
        self.n = len(lengths)
        self.half = 1 << max(0, (self.n - 1)).bit_length()
        self.length, self.count = np.zeros(2 * self.half, np.int64), np.zeros(2 * self.half, np.int64)
        for tree, values in ((self.length, lengths), (self.count, counts)):
            tree[self.half : self.half + self.n] = values
            level = self.half
            while level > 1:
                below = tree[level : 2 * level]
                tree[level // 2 : level] = below[0::2] + below[1::2]
                level //= 2

    @classmethod
    def build(cls, text: str, enc: tiktoken.Encoding) -> TokenTree:
        lengths = leaves(text)
        at = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
        return cls(lengths, [len(enc.encode_ordinary(text[a:b])) for a, b in zip(at[:-1], at[1:])])

    @property
    def total(self) -> int:
        return int(self.count[1])

    def leaf_lengths(self) -> np.ndarray:
        return self.length[self.half : self.half + self.n]

    def leaf_counts(self) -> np.ndarray:
        return self.count[self.half : self.half + self.n]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at this place, or the last one, and where it begins."""
        node, start = 1, 0
        while node < self.half:
            node *= 2
            if at - start >= self.length[node]:
                start += int(self.length[node])
                node += 1
        leaf = node - self.half
        while leaf >= self.n or (leaf > 0 and self.length[self.half + leaf] == 0):
            leaf -= 1
            start -= int(self.length[self.half + leaf])
        return leaf, start

    def set(self, leaf: int, length: int, count: int) -> None:
        """Change one leaf and the sums above it."""
        node = self.half + leaf
        self.length[node], self.count[node] = length, count
        while node > 1:
            node //= 2
            self.length[node] = self.length[2 * node] + self.length[2 * node + 1]
            self.count[node] = self.count[2 * node] + self.count[2 * node + 1]

    def edit(self, text: str, start: int, end: int, new: str, enc: tiktoken.Encoding) -> tuple[str, int]:
        """Replace ``text[start:end]``; returns the new text and how many characters were encoded again."""
        after = text[:start] + new + text[end:]
        if not self.n:
            self.load([len(after)], [len(enc.encode_ordinary(after))])
            return after, len(after)
        first, begin = self.find(start)
        if start == begin and first > 0:  # the cut before this leaf may no longer be one
            first -= 1
            begin -= int(self.length[self.half + first])
        last, tail = self.find(max(start, end - 1))
        tail += int(self.length[self.half + last])
        if end == tail and last + 1 < self.n:
            last += 1
            tail += int(self.length[self.half + last])
        fresh = after[begin : tail + len(after) - len(text)]
        self.set(first, len(fresh), len(enc.encode_ordinary(fresh)))
        for leaf in range(first + 1, last + 1):
            self.set(leaf, 0, 0)
        return after, len(fresh)


def apply_edits(
    tree: TokenTree, text: str, edits: Sequence[tuple[int, int, str]], enc: tiktoken.Encoding
) -> tuple[str, int]:
    """Apply edits given by places in the text as it was; from the back, so that places stay true.

    Edits are cut to the text; one that begins before the end of an earlier one in order is left out.
    """
    kept, at = [], 0
    for start, end, new in sorted((max(0, s or 0), e or 0, n or "") for s, e, n in edits):
        start, end = min(start, len(text)), min(max(start, end), len(text))
        if start >= at:
            kept.append((start, end, new))
            at = end
    encoded = 0
    for start, end, new in reversed(kept):
        text, count = tree.edit(text, start, end, new, enc)
        encoded += count
    return text, encoded


def token_count(spark: SparkSession, vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens; 0 for null and empty.

    Texts are encoded leaf by leaf, so memory beside the text does not grow with it.
    """
    sent = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        enc = encoding(sent.value)
        return pa.array([TokenTree.build(t or "", enc).total for t in texts.to_pylist()], pa.int64())

    return lambda text: count(text.cast("string"))


def token_trees(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text, n_tokens`` and the tree's leaves: ``leaf_chars`` and ``leaf_tokens``.

    Null and empty texts have no leaf and no token. Every row gives one row; others are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    long_list = T.ArrayType(T.LongType())
    schema = T.StructType([*rows.schema.fields, T.StructField("n_tokens", T.LongType()),
                           T.StructField("leaf_chars", long_list), T.StructField("leaf_tokens", long_list)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(sent.value)
        for batch in batches:
            trees = [TokenTree.build(t or "", enc) for t in batch.column(1).to_pylist()]
            columns = [
                pa.array([t.total for t in trees], pa.int64()),
                pa.array([t.leaf_lengths() for t in trees], pa.list_(pa.int64())),
                pa.array([t.leaf_counts() for t in trees], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.fieldNames())

    return rows.mapInArrow(run, schema).withColumnsRenamed({"key": key, "text": text})


def edited_counts(trees: DataFrame, vocabulary: Vocabulary, edits: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, n_edits, n_tokens_edited, chars_encoded, text_edited`` after the edits of each row.

    ``trees`` is what ``token_trees`` returns; ``edits`` an array of structs (start, end, new) in
    characters of the text as it is there. Null or empty edits leave the counts as they are.
    """
    sent = trees.sparkSession.sparkContext.broadcast(vocabulary)
    rows = trees.select(F.col(key).alias("key"), F.col(text).alias("text"), "leaf_chars", "leaf_tokens", edits.alias("edits"))
    names = ("n_tokens", "n_edits", "n_tokens_edited", "chars_encoded")
    schema = T.StructType([rows.schema["key"], *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("text_edited", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(sent.value)
        for batch in batches:
            out: list[tuple] = []
            cells = [batch.column(i) for i in range(1, 5)]
            for i in range(batch.num_rows):
                body, changes = cells[0][i].as_py(), cells[3][i].as_py() or []
                counts = cells[2][i].values.to_numpy() if cells[2][i].is_valid else np.zeros(0, np.int64)
                before = int(counts.sum())
                if not changes:
                    out.append((before, 0, before, 0, body))
                    continue
                tree = TokenTree(cells[1][i].as_py() or [], counts)
                spans = [(c["start"], c["end"], c["new"]) for c in changes]
                after, encoded = apply_edits(tree, body or "", spans, enc)
                out.append((before, len(changes), tree.total, encoded, after))
            columns = list(zip(*out)) if out else [[]] * 5
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema.fieldNames())

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def replacements(text: str, pattern: str, new: str) -> Column:
    """Edits that replace every match of a pattern, which must not match the empty text."""
    gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m))

    def summed(lengths: Column, upto: Column) -> Column:
        return F.aggregate(F.slice(lengths, F.lit(1), upto), F.lit(0), lambda a, x: a + x)

    def edit(size: Column, i: Column) -> Column:
        start = summed(gaps, i + 1) + summed(found, i)
        return F.struct(start.alias("start"), (start + size).alias("end"), F.lit(new).alias("new"))

    return F.when(F.col(text).rlike(pattern), F.transform(found, edit))
