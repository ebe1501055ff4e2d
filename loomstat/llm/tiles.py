"""Near-duplicate embeddings by products of int8 tiles with proven error bounds.

Equal vectors are one class. Each class's unit vector u is quantised to int8 codes q with a scale s, and
``e = |u - s q|`` is measured, so the cosine of two classes differs from ``s s' (q . q')`` by at most
``e + |s q| e'``. A tile holds the classes of one block; a product of two tiles decides every pair whose
estimate is further from the threshold than its bound, and only the pairs in between are worked out
again from the vectors in double precision. Products of codes are whole numbers below 2**24 (2**53 for wide
vectors), so the matrix products in floating point are exact.

Blocks are cells around pivots, cut further where a cell is large. Two cells are not multiplied at all if no
member of one can be near enough to any of the other, by the triangle inequality of angles and by the plane
halfway between their pivots; both tests only rule out what cannot be a link. Vectors without any
structure leave few cells to rule out, and then all tiles meet: the work is a product of the table with
itself, in blocks.

A product returns per class the weight of its links and a spanning forest, never the list of pairs, so a
group of any size costs rows in proportion to its members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.components import components
from loomstat.session import scratch_path

PIVOTS = 256
CELL_CLASSES = 4096  # classes per pivot, until there are PIVOTS of them
BLOCK_CLASSES = 8192
BLOCKS = 1024
BLOCK_BYTES = 32 << 20  # of double precision vectors in one block
STRIP, CHUNK = 512, 2048
EXACT_PAIRS = 1 << 15
SLACK = 1e-9  # for the rounding of bounds, norms and estimates, some 1e-15 each

CLASS_FIELDS = "c long, h1 long, h2 long, v array<double>, n long"
BLOCK_FIELDS = (
    "block int, c binary, n binary, codes binary, scale binary, error binary, reach binary, unit binary, width int"
)
FOUND_FIELDS = "i int, j int, again boolean, c long, links long, root long"


def _usable(v: str) -> Column:
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    return finite & F.exists(v, lambda c: c != 0)


def _unit(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, distances from the unit vectors and lengths of the coded vectors."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.sqrt(((unit - coded) ** 2).sum(1)), np.sqrt((coded * coded).sum(1))


class Cells:
    """Pivots per width, and which pairs of cells may hold a link."""

    def __init__(self, pivots: dict[int, np.ndarray]):
        self.pivots = pivots
        self.first: dict[int, int] = {}
        self.count = 0
        for width, rows in pivots.items():
            self.first[width] = self.count
            self.count += len(rows)

    def homes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines with the pivots of this width, and the cell of the nearest."""
        cosines = unit @ self.pivots[unit.shape[1]].T
        return cosines, cosines.argmax(1)

    def pairs(self, width: int, near: np.ndarray, low: np.ndarray, gap: np.ndarray, threshold: float) -> np.ndarray:
        """True where members of cells a and b may have a cosine of at least the threshold.

        ``near[a, b]`` is the largest cosine of a member of a with pivot b, ``gap[a, b]`` by how much
        its own pivot is nearer at least, ``low[a]`` the least cosine of a member with its own pivot.
        """
        angle = lambda x: np.arccos(np.clip(x, -1.0, 1.0))
        out_of_ball = angle(near) > angle(low)[None, :] + angle(threshold) + 1e-7
        apart = np.linalg.norm(self.pivots[width][:, None] - self.pivots[width][None], axis=2)
        beyond_plane = gap > math.sqrt(max(0.0, 2 - 2 * threshold)) * apart + SLACK
        never = out_of_ball | beyond_plane
        return ~(never | never.T) & np.isfinite(low)[:, None] & np.isfinite(low)[None, :]


def _classes(rows: DataFrame, path: str) -> DataFrame:
    """Distinct vectors with their number and least key, written with a number of their own."""
    classes = rows.filter(F.col("h1").isNotNull()).groupBy("h1", "h2", "v")
    found = classes.agg(F.count("*").alias("n"), F.min("k").alias("least"))
    found.withColumn("c", F.monotonically_increasing_id()).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _pivots(classes: DataFrame, widths: dict[int, int]) -> Cells:
    """Those with the least hashes; a width that has none gets one cell for all its vectors."""
    wanted = min(PIVOTS, max(1, sum(widths.values()) // CELL_CLASSES))
    chosen: dict[int, list] = {w: [] for w in widths}
    for row in classes.select("v", "h1", "h2").orderBy("h1", "h2").limit(wanted).collect():
        chosen[len(row["v"])].append(row["v"])
    rows = {w: _unit(pa.array(v), w) if v else np.zeros((1, w)) for w, v in chosen.items()}
    return Cells(rows)


def _split_by_width(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.diff(np.asarray(table.column("v").offsets))
    for width in np.unique(lengths):
        yield int(width), np.flatnonzero(lengths == width)


def _measured(classes: DataFrame, cells: Cells) -> list[tuple[np.ndarray, ...]]:
    """Per width: members, and over them near, low and gap (see ``Cells.pairs``); one pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at in _split_by_width(batch):
                cosines, home = cells.homes(_unit(batch.column("v").take(pa.array(at)), width))
                own = cosines[np.arange(len(home)), home]
                out = []
                for a in np.unique(home):
                    mine = home == a
                    out.append(
                        (width, int(a), int(mine.sum()), float(own[mine].min()), cosines[mine].max(0),
                         (own[mine][:, None] - cosines[mine]).min(0))
                    )
                names = ["width", "a", "n", "low", "near", "gap"]
                yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], names)

    kinds = "width long, a long, n long, low double, near array<double>, gap array<double>"
    parts = classes.select("v").mapInArrow(work, kinds)
    each = parts.select("width", "a", "n", "low", F.posexplode(F.arrays_zip("near", "gap")).alias("b", "x"))
    most = each.groupBy("width", "a", "b").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("x.near").alias("near"), F.min("x.gap").alias("gap")
    )
    size = {w: len(p) for w, p in cells.pivots.items()}
    tables = {
        w: (np.zeros(s, np.int64), np.full((s, s), -1.0), np.full(s, np.inf), np.zeros((s, s))) for w, s in size.items()
    }
    for r in most.collect():  # at most the square of the pivots, which are bounded
        n, near, low, gap = tables[r["width"]]
        n[r["a"]], low[r["a"]] = r["n"], r["low"]
        near[r["a"], r["b"]], gap[r["a"], r["b"]] = r["near"], r["gap"]
    return [(w, *t) for w, t in tables.items()]


def _blocks(classes: DataFrame, cells: Cells, cuts: np.ndarray, first: np.ndarray, path: str) -> DataFrame:
    """One row per block: its classes' numbers, weights, codes, scales, errors and unit vectors."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.zeros(batch.num_rows, np.int32)
            for width, at in _split_by_width(batch):
                _, home = cells.homes(_unit(batch.column("v").take(pa.array(at)), width))
                cell = cells.first[width] + home
                block[at] = first[cell] + np.asarray(batch.column("h2"))[at] % cuts[cell]
            yield pa.RecordBatch.from_arrays(
                [batch.column("c"), batch.column("n"), batch.column("v"), pa.array(block)], ["c", "n", "v", "block"]
            )

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        v = group.column("v").chunk(0)
        width = len(v[0])
        unit = _unit(v, width)
        codes, scale, error, reach = quantised(unit)
        order = np.argsort(scale, kind="stable")  # so that a chunk's scales are alike
        numbers = [np.asarray(group.column(x), np.int64)[order] for x in ("c", "n")]
        cells_ = [*numbers, codes[order], scale[order], error[order], reach[order], unit[order]]
        columns = [pa.array([group.column("block")[0].as_py()], pa.int32())]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in cells_]
        names = [f.split()[0] for f in BLOCK_FIELDS.split(", ")]
        return pa.table([*columns, pa.array([width], pa.int32())], names)

    placed = classes.select("c", "n", "v", "h2").mapInArrow(place, "c long, n long, v array<double>, block int")
    placed.groupBy("block").applyInArrow(pack, BLOCK_FIELDS).write.parquet(path)
    return classes.sparkSession.read.parquet(path)


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of each pair; every node points at its root before and after."""
    while True:
        a, b = parent[i], parent[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


class Tile:
    """The arrays of one block."""

    def __init__(self, row: dict):
        self.c, self.n = (np.frombuffer(row[x], np.int64) for x in ("c", "n"))
        self.scale, self.error, self.reach = (np.frombuffer(row[x], float) for x in ("scale", "error", "reach"))
        width = row["width"]
        kind = np.float32 if width <= 1024 else float  # 127 * 127 * 1024 < 2**24: exact
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(-1, width).astype(kind)
        unit = row.get("unit")
        self.unit = None if unit is None else np.frombuffer(unit, float).reshape(-1, width)


def _exact(a: Tile, b: Tile, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), EXACT_PAIRS):
        to = slice(at, at + EXACT_PAIRS)
        out[to] = np.einsum("ij,ij->i", a.unit[i[to]], b.unit[j[to]]) >= threshold
    return out


def product(a: Tile, b: Tile, same: bool, threshold: float):
    """Weights of the links of a's and b's classes, and the roots of a spanning forest over a then b.

    None if a pair is too near the threshold for its bound and the tiles carry no unit vectors. With
    ``same`` the tiles are one block, whose pairs are taken once.
    """
    na, nb = len(a.c), len(b.c)
    weight_a, weight_b = np.zeros(na), np.zeros(nb)
    parent = np.arange(na if same else na + nb)
    shift = 0 if same else na
    for at in range(0, na, STRIP):
        rows = slice(at, min(na, at + STRIP))
        for bt in range(at // CHUNK * CHUNK if same else 0, nb, CHUNK):
            columns = slice(bt, min(nb, bt + CHUNK))
            dots = a.codes[rows] @ b.codes[columns].T
            room = threshold - SLACK - a.error[rows] - a.reach[rows] * b.error[columns].max()
            scale = np.where(room > 0, b.scale[columns].max(), b.scale[columns].min())
            hit = np.flatnonzero(dots >= (room / (a.scale[rows] * scale)).astype(dots.dtype)[:, None] * (1 - np.sign(room)[:, None] * 1e-6))
            if not len(hit):
                continue
            i, j = np.divmod(hit, dots.shape[1])
            estimate = dots.ravel()[hit].astype(float)
            i, j = i + at, j + bt
            if same:
                once = i < j
                i, j, estimate = i[once], j[once], estimate[once]
            estimate = estimate * a.scale[i] * b.scale[j]
            bound = a.error[i] + a.reach[i] * b.error[j] + SLACK
            link = estimate - bound >= threshold
            open_ = ~link & (estimate + bound >= threshold)
            if open_.any():
                if a.unit is None:
                    return None
                link[open_] = _exact(a, b, i[open_], j[open_], threshold)
            i, j = i[link], j[link]
            weight_a += np.bincount(i, b.n[j], na)
            weight_b += np.bincount(j, a.n[i], nb)
            _merge(parent, i, j + shift)
    if same:
        weight_a = weight_a + weight_b
    return weight_a, weight_b, parent


def _products(blocks: DataFrame, pairs: DataFrame, threshold: float, exact: bool) -> DataFrame:
    """Products of all listed pairs of blocks: ``FOUND_FIELDS``, with ``again`` for undecided ones."""
    names = [f.split()[0] for f in FOUND_FIELDS.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]

    def work(group: pa.Table) -> pa.Table:
        rows = {r["block"]: r for r in group.to_pylist()}
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        a, b = Tile(rows[i]), Tile(rows[j])
        found = product(a, b, i == j, threshold)
        if found is None:
            columns = [[i], [j], [True], [None], [None], [None]]
        else:
            weight_a, weight_b, parent = found
            c = a.c if i == j else np.concatenate([a.c, b.c])
            weight = weight_a if i == j else np.concatenate([weight_a, weight_b])
            at = np.flatnonzero(weight > 0)
            fixed = [np.full(len(at), x) for x in (i, j, False)]
            columns = [*fixed, c[at], weight[at].astype(np.int64), c[parent[at]]]
        return pa.table([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)

    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return sides.join(blocks if exact else blocks.drop("unit"), "block").groupBy("i", "j").applyInArrow(work, FOUND_FIELDS)


def _links(classes: DataFrame, threshold: float) -> DataFrame:
    """``c, links, root``: several rows per class; each hangs it on another of its component."""
    spark = classes.sparkSession
    widths = {r["w"]: r["n"] for r in classes.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).collect()}
    cells = _pivots(classes, widths)
    measured = _measured(classes, cells)
    total, widest = sum(widths.values()), max(widths, default=1)
    rows = max(1, min(max(BLOCK_CLASSES, total // BLOCKS), BLOCK_BYTES // (8 * widest)))
    cuts = np.concatenate([np.ones(0, np.int64), *[-(-n // rows) for _, n, *_ in measured]]).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(cuts)[:-1]]).astype(np.int64) if len(cuts) else cuts
    blocks = _blocks(classes, cells, np.maximum(cuts, 1), first, scratch_path(spark, "tiles"))
    met = []
    for width, _, near, low, gap in measured:
        a, b = np.nonzero(np.triu(cells.pairs(width, near, low, gap, threshold)))
        for x, y in zip((a + cells.first[width]).tolist(), (b + cells.first[width]).tolist()):
            met.append((int(first[x]), int(cuts[x]), int(first[y]), int(cuts[y])))
    cell_pairs = spark.createDataFrame(met, "fa int, na int, fb int, nb int")
    each = cell_pairs.select("fb", "nb", F.explode(F.expr("sequence(fa, fa + na - 1)")).alias("i"))
    pairs = each.select("i", F.explode(F.expr("sequence(fb, fb + nb - 1)")).alias("j")).filter("i <= j")
    path, again = scratch_path(spark, "links"), scratch_path(spark, "links-again")
    _products(blocks, pairs, threshold, exact=False).write.parquet(path)
    found = spark.read.parquet(path)
    open_ = found.filter("again").select("i", "j")
    _products(blocks, open_, threshold, exact=True).write.parquet(again)
    return found.filter(~F.col("again")).unionByName(spark.read.parquet(again)).select("c", "links", "root")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``key, n_links, component_id, kept`` per row of ``df``.

    Rows link when the cosine of their vectors is at least the threshold (above 0). ``n_links`` counts the
    other rows linked directly, ``component_id`` is the least key reachable by links, a row's own
    included, and ``kept`` is true where both are equal. Null, empty, zero and incomplete vectors link with
    nothing, and so do vectors of different widths. Keys may repeat or be null: each row counts, the
    least key passes over nulls, and a null key is kept only if its whole component has no key. An
    empty table gives no rows; no other column is read.

    Equal vectors are told by two 64-bit hashes when results go back to the rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0, and 1 at most")
    spark = df.sparkSession
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = df.select(F.col(key).alias("k"), v.alias("v"))
    mark = F.when(_usable("v"), F.struct(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
    rows = rows.select("k", "v", mark.alias("_m")).select("k", "v", "_m.h1", "_m.h2")
    classes = _classes(rows, scratch_path(spark, "classes"))
    links = _links(classes, threshold)
    weight = links.groupBy("c").agg(F.sum("links").alias("links"))
    hung = components(links.filter("c <> root").select(F.col("c").alias("u"), F.col("root").alias("v")))
    placed = classes.select("c", "h1", "h2", "n", "least").join(weight, "c", "left")
    placed = placed.filter((F.col("n") > 1) | F.col("links").isNotNull())
    placed = placed.join(hung.select(F.col("u").alias("c"), F.col("v").alias("up")), "c", "left")
    placed = placed.withColumn("root", F.coalesce("up", "c"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    done = placed.join(least, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component"
    )
    out = rows.select("k", "h1", "h2").join(done, ["h1", "h2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("k")).otherwise(F.col("component"))
    return out.select(
        F.col("k").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("k").eqNullSafe(component).alias("kept"),
    )
