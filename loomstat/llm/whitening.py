"""Whitening of embeddings by shifted Cholesky QR.

The fit looks at each distinct vector of whole numbers once. Their centred matrix A (n rows, d columns)
is never held in one place: each pass sends every row through the triangular factors found so far and
adds up the d x d Gram matrix of what comes out. The first factor comes from the Gram matrix plus a shift
``11 (n d + d (d + 1)) u |A|^2``, which makes the Cholesky factorisation succeed for any A; each further
pass makes the columns more nearly orthogonal, until the Gram matrix is the identity (or, where A has
not full rank, a projection). The product R of all factors then satisfies A = QR with orthonormal Q, so
the singular values and right vectors of the small matrix R are those of A, to double precision, where
the eigenvalues of ``A'A`` itself would have lost half the digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.session import scratch_path

UNIT = 2.0**-53
PASSES = 12
SETTLED = 1e-7  # how near the Gram matrix must be to a projection; the next factor squares what is left
LOW_BITS = 26


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums``; unit components in rows, by falling eigenvalue.

    ``eigenvalues`` are those of the components, zero where the vectors have no spread; ``total`` is the
    sum of all of them. ``identity_error`` is the largest entry of the whitened rows' covariance minus
    the identity, over the components with spread (None if there is none). ``passes`` counts Gram passes.
    """

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    total: float
    identity_error: float | None
    passes: int


def whole_numbers(df: DataFrame, vector: str, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """All columns and ``_x``: entry c becomes ``floor(scale * c) + offset`` as long.

    Rows whose vector is null, empty, or holds a null, a non-finite entry or one beyond the longs are
    left out.
    """
    c = F.transform(F.col(vector), lambda v: v.cast("double") * scale)
    known = df.withColumn("_c", c)
    reach = F.lit(2.0**62)
    whole = F.forall("_c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < reach))
    x = F.transform("_c", lambda v: F.floor(v).cast("long") + offset)
    return known.filter(whole & (F.size("_c") > 0)).withColumn("_x", x).drop("_c")


def _same_width(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the most common width (the larger one of equals) and that width; 0 for an empty table."""
    sizes = df.groupBy(F.size("_x").alias("w")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.col("n").desc(), F.col("w").desc()).first()
    width = most["w"] if most else 0
    return df.filter(F.size("_x") == width), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """``n * x - sums``, exact: as int64 where that holds it, else as Python integers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if largest < 2**62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squared_lengths(d: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if d.dtype == object or np.abs(d).max(initial=0) >= 2**53:
        return [sum(int(v) ** 2 for v in row) for row in d]
    high, low = d >> LOW_BITS, d & ((1 << LOW_BITS) - 1)  # at most 27 and 26 bits: sums of up to 2**9 fit
    parts = [np.zeros(len(d), object)]
    for at in range(0, d.shape[1], 256):
        h, w = high[:, at : at + 256], low[:, at : at + 256]
        squares = [(a * b).sum(1).astype(object) for a, b in ((h, h), (h, w), (w, w))]
        parts.append((squares[0] << 2 * LOW_BITS) + (squares[1] << LOW_BITS + 1) + squares[2])
    return list(sum(parts))


def solved_rows(rows: np.ndarray, factors: Sequence[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular factors, one forward substitution each."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _summed(df: DataFrame, work, kind: str) -> dict[int, list]:
    """Adds up matrices: ``work`` maps the batches of a task to (row number, row) pairs.

    Each task sends one matrix, whose entries are summed by position; the result, which depends on the
    width alone, comes to the driver.
    """
    parts = df.mapInArrow(work, f"i int, row array<{kind}>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("row")).collect()
    return {r["i"]: [cell["v"] for cell in r["row"]] for r in rows}


def _totals(x: DataFrame, width: int) -> tuple[int, list[int]]:
    """Exact number of rows and sums per entry, through halves of 32 bits that cannot overflow."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            m = _matrix(batch.column(0), width)
            n, high, low = n + len(m), high + (m >> 32).sum(0), low + (m & 0xFFFFFFFF).sum(0)
        rows = [[n] * width, high, low]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(rows, pa.list_(pa.int64()))], ["i", "row"])

    found = _summed(x, work, "long")
    if not found or not found[0][0]:
        return 0, [0] * width
    return int(found[0][0]), [(int(h) << 32) + int(w) for h, w in zip(found[1], found[2])]


def _gram(x: DataFrame, n: int, sums: list[int], factors: list[np.ndarray], scale: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after all factors, or of their products with ``scale``."""
    width = len(sums)
    out = width if scale is None else scale.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out, out))
        for batch in batches:
            rows = deviations(_matrix(batch.column(0), width), n, sums).astype(float) / n
            rows = solved_rows(rows, factors) if scale is None else rows @ scale
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(out), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"]
        )

    found = _summed(x, work, "double")
    return np.array([found[i] for i in range(out)])


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor; shifted in the first pass and wherever the matrix is nearly singular."""
    d = len(gram)
    gram = (gram + gram.T) / 2
    values = np.linalg.eigvalsh(gram)
    if first or values[0] < 0.1 * values[-1]:
        shift = 11.0 * (n * d + d * (d + 1)) * UNIT * values[-1]
        gram = gram + max(shift, np.finfo(float).tiny) * np.eye(d)
    return np.linalg.cholesky(gram).T


def _last_factor(gram: np.ndarray) -> np.ndarray:
    """Cholesky factor of a Gram matrix that has settled; without full rank, the rows of its root that
    are not zero, as the shifts of earlier factors leave traces where the rows have no spread."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    if values[0] > 0.5:
        return np.linalg.cholesky((gram + gram.T) / 2).T
    kept = values > 0.5
    return np.sqrt(values[kept])[:, None] * vectors[:, kept].T


def triangular_factor(x: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, int]:
    """R of the centred rows (fewer rows than columns without full rank), and the passes it took."""
    factors: list[np.ndarray] = []
    product = np.eye(len(sums))
    for k in range(PASSES):
        gram = _gram(x, n, sums, factors)
        if k and np.abs(gram @ gram - gram).max() < SETTLED:
            break
        factors.append(_factor(gram, n, first=k == 0))
        product = factors[-1] @ product
    return _last_factor(gram) @ product, k + 1


def fit(df: DataFrame, components: int = 16) -> tuple[Whitening, int]:
    """Whitening of the distinct vectors ``_x`` of ``df`` (see ``whole_numbers``), and their width.

    Distinct vectors are found by grouping, copies combined before the shuffle, and written once to the
    shared folder, from which every pass reads. Vectors of another width than the most common one are
    left out. The driver gets sums and d x d matrices, whose size does not depend on the rows.
    """
    path = scratch_path(df.sparkSession, "whitening")
    same, width = _same_width(df.select("_x"))
    same.distinct().write.parquet(path)
    x = df.sparkSession.read.parquet(path)
    n, sums = _totals(x, width) if width else (0, [])
    if not n:
        return Whitening(0, sums, np.zeros((0, width)), np.zeros(0), 0.0, None, 0), width
    r, passes = triangular_factor(x, n, sums)
    _, found, vectors = np.linalg.svd(r)
    sigma = np.zeros(width)
    sigma[: len(found)] = np.where(found > 128 * width * UNIT * found[:1], found, 0.0)
    values = sigma * sigma / n
    kept = min(components, width)
    spread = int((values[:kept] > 0).sum())
    error = None
    if spread:
        # the centred rows add up to zero exactly, and so do their products with the components
        scale = vectors[:spread].T / np.sqrt(values[:spread])
        error = float(np.abs(_gram(x, n, sums, [], scale) / n - np.eye(spread)).max())
    return Whitening(n, sums, vectors[:kept], values[:kept], float(values.sum()), error, passes), width


def transform(df: DataFrame, model: Whitening, keep: Sequence[str]) -> DataFrame:
    """``keep``, and for each row of ``df`` (with ``_x``) its ``deviation decimal(38, 0)`` and ``whitened``.

    ``deviation`` is the exact squared length of ``n * x - sums``, null beyond 38 digits. ``whitened``
    holds a number per component, null where the component has no spread. Rows of another width than
    the model's are left out. Nothing is shuffled.
    """
    width, n, sums = len(model.sums), model.n, model.sums
    spread = int((model.eigenvalues > 0).sum())
    scale = model.components[:spread].T / np.sqrt(model.eigenvalues[:spread])
    missing = len(model.components) - spread
    rows = df.filter(F.size("_x") == width).select(*keep, "_x")
    fields = [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*rows.schema.fields[:-1], *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = deviations(_matrix(batch.column(batch.num_columns - 1), width), n, sums)
            lengths = [Decimal(v) if v < 10**38 else None for v in squared_lengths(d)]
            values = (d.astype(float) / n) @ scale
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns.append(pa.array(lengths, pa.decimal128(38, 0)))
            flat = pa.array(np.concatenate([values, np.full((len(values), missing), np.nan)], 1).ravel(), from_pandas=True)
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * (spread + missing))
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, flat)], schema.fieldNames())

    return rows.mapInArrow(work, schema)


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 16) -> DataFrame:
    """``key``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``:
    one row per vector left and component.

    Null, empty and incomplete vectors and those of an uncommon width give no row; keys may be null or
    repeated, each row stands for itself. Without spread ``whitened`` is null; without any spread in the
    table ``explained`` and ``identity_error`` are null too. An empty table gives no rows. There are at
    most as many components as entries.
    """
    rows = whole_numbers(df.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")), "_vector").select("_key", "_x")
    model, _ = fit(rows, components)
    placed = transform(rows, model, ["_key"]).select("*", F.posexplode("whitened").alias("_at", "_value"))
    shares = [float(v / model.total) if model.total else None for v in model.eigenvalues]
    explained = F.get(F.array(*[F.lit(s).cast("double") for s in shares]), F.col("_at")) if shares else F.lit(None)
    return placed.select(
        F.col("_key").alias(key),
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("_value").alias("whitened"),
        explained.cast("double").alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
