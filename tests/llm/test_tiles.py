import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import tiles

SCHEMA = "vec_id long, embedding array<double>, label int"


def table(spark, rows):
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in ("k", "v", "n", "h1", "c", "block", "component")})


def usable(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def plain(rows, threshold):
    """All pairs, in double precision."""
    unit = [np.array(v) / np.abs(v).max() if usable(v) else None for _, v in rows]
    unit = [None if u is None else u / np.sqrt(u @ u) for u in unit]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    out = [(rows[i][0], links[i], least.get(root(i)), rows[i][0] == least.get(root(i))) for i in range(n)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def groups(rng, centers, each, width, noise):
    """Vectors around common centers, with cosines on both sides of 0.9."""
    rows = []
    for _ in range(centers):
        center = rng.normal(size=width)
        rows += [center + rng.normal(size=width) * noise * rng.random() for _ in range(each)]
    return rows


def sample(seed):
    rng = np.random.default_rng(seed)
    rows = groups(rng, 12, 40, 16, 0.7) + list(rng.normal(size=(150, 16))) + groups(rng, 3, 10, 5, 0.6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rows)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(30)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[600][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] * 16), (2004, [float("nan")] * 16), (None, None)]
    rows += [(2005, [float("-inf")] * 16), (2006, [1e300] * 16), (2007, [1e-300] * 16), (2008, [1.0] * 16), (2009, [-0.0, 2.0]), (2010, [0.0, 3.0])]
    return rows


@pytest.mark.parametrize(("cell", "block"), [(4096, 8192), (40, 25), (10, 8192)])
def test_rows_equal_all_pairs(spark, monkeypatch, cell, block):
    """With one tile, with many cut cells, and with many small cells."""
    monkeypatch.setattr(tiles, "CELL_CLASSES", cell)
    monkeypatch.setattr(tiles, "BLOCK_CLASSES", block)
    rows = sample(cell + block)
    assert found(tiles.near_duplicates(table(spark, rows))) == plain(rows, 0.9)


def test_other_thresholds_and_nothing(spark):
    rows = sample(1)[:200]
    assert found(tiles.near_duplicates(table(spark, rows), threshold=0.97)) == plain(rows, 0.97)
    assert tiles.near_duplicates(table(spark, [])).collect() == []
    assert found(tiles.near_duplicates(table(spark, [(1, None), (2, [0.0])]))) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        tiles.near_duplicates(table(spark, []), threshold=0.0)


@pytest.mark.parametrize("width", [1, 3, 64, 1500])
def test_bounds_hold_for_every_pair(width):
    rng = np.random.default_rng(width)
    unit = rng.normal(size=(60, width)) * rng.choice([1, 1e-3, 30], size=(60, width))
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    codes, scale, error, reach = tiles.quantised(unit)
    estimate = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale[None]
    bound = error[:, None] + reach[:, None] * error[None] + 1e-12
    assert (np.abs(unit @ unit.T - estimate) <= bound).all()


def tile(unit, weights, first, full):
    codes, scale, error, reach = tiles.quantised(unit)
    cells = {"codes": codes, "scale": scale, "error": error, "reach": reach, "unit": unit, "n": weights}
    row = {k: v.tobytes() for k, v in cells.items()} | {"c": np.arange(first, first + len(unit)).tobytes(), "width": unit.shape[1]}
    return tiles.Tile(row if full else {k: v for k, v in row.items() if k != "unit"})


def test_strips_and_chunks_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    unit = np.array(groups(rng, 6, 30, 8, 0.7))
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    weights = rng.integers(1, 5, len(unit))
    linked = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    for strip, chunk in ((512, 2048), (7, 11), (16, 8)):
        monkeypatch.setattr(tiles, "STRIP", strip)
        monkeypatch.setattr(tiles, "CHUNK", chunk)
        weight, _, parent = tiles.product(tile(unit, weights, 0, True), tile(unit, weights, 0, True), True, 0.9)
        assert (weight == linked @ weights).all() and len(set(parent)) <= 180
        a, b = tile(unit[:100], weights[:100], 0, True), tile(unit[100:], weights[100:], 100, True)
        left, right, parent = tiles.product(a, b, False, 0.9)
        assert (left == linked[:100, 100:] @ weights[100:]).all() and (right == linked[100:, :100] @ weights[:100]).all()
    assert tiles.product(tile(unit, weights, 0, False), tile(unit, weights, 0, False), True, 0.9) is None


def test_pairs_of_cells_without_links_are_left_out_and_no_other():
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(40, 6))
    unit = np.concatenate([c + rng.normal(size=(25, 6)) * 0.15 for c in centers])
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    cells = tiles.Cells({6: unit[::25]})
    cosines, home = cells.homes(unit)
    own = cosines[np.arange(len(unit)), home]
    members = [home == a for a in range(40)]
    near = np.array([cosines[m].max(0) for m in members])
    gap = np.array([(own[m][:, None] - cosines[m]).min(0) for m in members])
    low = np.array([own[m].min() for m in members])
    met = cells.pairs(6, near, low, gap, 0.9)
    linked = unit @ unit.T >= 0.9
    for a in range(40):
        for b in range(40):
            assert met[a, b] or not linked[np.ix_(members[a], members[b])].any()
    assert met.mean() < 0.5
