"""Decision trees grown level by level from histograms over several features.

Every feature is cut once into at most ``max_bins`` bins, and from then on a row is a list of bin numbers. A
level costs one aggregate: sums per (node, feature, bin), combined before the shuffle, of which the split of
every open node is chosen by running sums over the bins. Only the smaller child of each split is
counted from rows; its sibling's histogram is the parent's minus it. The driver learns one row per
node. Classes are counted one by one, so there may be more than two.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.functions import doubles
from loomstat.operators.classify import check_tree
from loomstat.operators.partitions import held
from loomstat.session import scratch_path

QUANTILE_ACCURACY = 10_000
LEAST_GAIN = 1e-12  # of the node's impurity


@dataclass
class Tree:
    """Nodes in the order they were made; node 0 is the root, ``left[i] + 1`` the right child of i.

    ``feature`` is -1 in a leaf. ``heap`` numbers nodes from 1, children of i being 2i and 2i + 1.
    ``sums`` holds a node's rows per class, or the count, sum and square sum of its labels.
    """

    features: list[str]
    classes: list[float] | None
    heap: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    sums: list[list[float]] = field(default_factory=list)

    def add(self, heap: int, sums: list[float]) -> int:
        for cells, value in zip(
            (self.heap, self.feature, self.threshold, self.bin, self.left, self.gain, self.sums),
            (heap, -1, 0.0, 0, 0, 0.0, sums),
        ):
            cells.append(value)
        return len(self.heap) - 1

    def size(self, i: int) -> float:
        return self.sums[i][0] if self.classes is None else sum(self.sums[i])

    def value(self, i: int) -> float:
        """Mean label, or the most frequent class (the least of equals)."""
        if self.classes is None:
            return self.sums[i][1] / self.sums[i][0]
        return self.classes[int(np.argmax(self.sums[i]))]

    @property
    def depth(self) -> int:
        return max(h.bit_length() for h in self.heap) - 1 if self.heap else 0


def _cuts(data: DataFrame, width: int, max_bins: int) -> list[list[float]]:
    """Per feature: midpoints between its values if there are few, else approximate quantiles; two passes."""
    names = [f"_x{j}" for j in range(width)]
    shares = [i / max_bins for i in range(1, max_bins)]
    seen = data.agg(
        *[F.approx_count_distinct(x).alias(f"n{x}") for x in names],
        *[F.percentile_approx(x, doubles(shares), QUANTILE_ACCURACY).alias(f"q{x}") for x in names],
    ).first()
    few = [x for x in names if seen[f"n{x}"] <= 2 * max_bins]
    values = data.agg(*[F.array_sort(F.collect_set(x)).alias(x) for x in few]).first() if few else {}
    out = []
    for x in names:
        if x in few and len(values[x]) <= max_bins:
            out.append([(a + b) / 2 for a, b in zip(values[x], values[x][1:])])
        else:
            out.append(sorted(set(seen[f"q{x}"] or [])))
    return out


def _binned(data: DataFrame, cuts: list[list[float]], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``_bins``: per feature how many cuts lie below the value (a value on a cut stays below)."""
    some = [j for j, own in enumerate(cuts) if own]
    # the bucketizer puts a value on a cut above it, so it works on the negated columns
    placed = data.withColumns({f"_d{j}": -F.col(f"_x{j}") for j in some})
    if some:
        splits = [[-math.inf, *[-c for c in reversed(cuts[j])], math.inf] for j in some]
        names = {"inputCols": [f"_d{j}" for j in some], "outputCols": [f"_b{j}" for j in some]}
        placed = Bucketizer(splitsArray=splits, **names).transform(placed)
    bins = [F.lit(len(own)) - F.col(f"_b{j}").cast("int") if own else F.lit(0) for j, own in enumerate(cuts)]
    return placed.select(*keep, F.array(*bins).alias("_bins"))


def _walk(tree: Tree, goes_left) -> Column:
    """The node where a row ends; ``goes_left(node)`` tells which child it goes to from a split."""
    feature, left = F.lit(np.array(tree.feature)), F.lit(np.array(tree.left))

    def step(node: Column, _: Column) -> Column:
        child = F.get(left, node) + F.when(goes_left(node), 0).otherwise(1)
        return F.when(F.get(feature, node) < 0, node).otherwise(child.cast("int"))

    return F.aggregate(F.array_repeat(F.lit(0), tree.depth), F.lit(0), step)


def _node_of_bins(tree: Tree) -> Column:
    feature, cut = F.lit(np.array(tree.feature)), F.lit(np.array(tree.bin))
    return _walk(tree, lambda n: F.get(F.col("_bins"), F.get(feature, n).cast("int")) <= F.get(cut, n))


def predict(tree: Tree) -> Column:
    """The tree's prediction for a row with the feature columns; null where a feature it asks for is."""
    if not tree.heap:
        return F.lit(None).cast("double")
    xs = F.array(*[F.col(f).cast("double") for f in tree.features])
    feature, threshold = F.lit(np.array(tree.feature)), doubles(tree.threshold)
    node = _walk(tree, lambda n: F.get(xs, F.get(feature, n).cast("int")) <= F.get(threshold, n))
    whole = F.forall(xs, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.when(whole, F.get(doubles([tree.value(i) for i in range(len(tree.heap))]), node))


def _impurity(kind: str, sums: list[Column]) -> Column:
    if kind == "Variance":
        size = F.nullif(sums[0], F.lit(0.0))
        return F.greatest(sums[2] / size - (sums[1] / size) * (sums[1] / size), F.lit(0.0))
    size = F.nullif(sum(sums[1:], sums[0]), F.lit(0.0))
    shares = [s / size for s in sums]
    if kind == "Gini":
        return F.lit(1.0) - sum((p * p for p in shares[1:]), shares[0] * shares[0])
    bits = [F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in shares]
    return sum(bits[1:], bits[0])


def _best_splits(histogram: DataFrame, kind: str, stats: list[str]) -> DataFrame:
    """Per node its sums, and feature and bin of the best split, if one lowers the impurity.

    Windows run over the bins of one (node, feature). Gains are compared relative to the node's
    impurity; among equals the first feature and the lowest cut win.
    """
    one = Window.partitionBy("node", "f")
    left = histogram.select("node", "f", "bin", *[F.sum(s).over(one.orderBy("bin")).alias(f"l{s}") for s in stats],
                            *[F.sum(s).over(one).alias(f"t{s}") for s in stats])
    total, below = [F.col(f"t{s}") for s in stats], [F.col(f"l{s}") for s in stats]
    above = [t - b for t, b in zip(total, below)]

    def size(sums: list[Column]) -> Column:
        return sums[0] if kind == "Variance" else sum(sums[1:], sums[0])

    before = _impurity(kind, total)
    after = F.coalesce(_impurity(kind, below), F.lit(0.0)) * size(below)
    after = (after + F.coalesce(_impurity(kind, above), F.lit(0.0)) * size(above)) / size(total)
    scored = left.select("node", "f", "bin", *total, *below, (before - after).alias("gain"), before.alias("before"),
                         size(above).alias("_rest"))
    share = F.coalesce(F.col("gain") / F.nullif(F.col("before"), F.lit(0.0)), F.lit(0.0))
    worth = (F.col("_rest") > 0) & (share > LEAST_GAIN)
    rank = F.struct(F.round(share, 12).alias("share"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"))
    cells = F.struct("f", "bin", "gain", F.array(*below).alias("below"))
    return scored.groupBy("node").agg(
        F.first(F.array(*total)).alias("total"), F.max_by(F.when(worth, cells), F.when(worth, rank)).alias("best")
    )


def _counted(rows: DataFrame, node: Column, wanted: list[int], stats: dict[str, Column]) -> DataFrame:
    """Histogram of the wanted nodes: ``node, f, bin`` and the sums; one aggregate."""
    own = rows.select("_bins", "_y", node.alias("node"))
    # rows of other nodes have no cells; a filter would be pushed below and walk the tree a second time
    each = own.select("node", "_y", F.posexplode(F.when(F.col("node").isin(wanted), F.col("_bins"))).alias("f", "bin"))
    return each.groupBy("node", "f", "bin").agg(*[F.sum(c).alias(s) for s, c in stats.items()])


def grow(
    rows: DataFrame,
    label: str,
    features: Sequence[str],
    algo: str = "Classification",
    max_depth: int = 5,
    impurity: str = "Gini",
    max_bins: int = 100,
) -> Tree:
    """Grow a tree; rows with a missing label or feature are left out, and none leave no node.

    Classes are the distinct labels; a class adds a column to the histograms. A node is split while a
    split lowers its impurity and ``max_depth`` allows it.
    """
    check_tree(algo, impurity)
    spark = rows.sparkSession
    xs = [F.col(f).cast("double").alias(f"_x{j}") for j, f in enumerate(features)]
    whole = rows.select(F.col(label).cast("double").alias("_y"), *xs).dropna()  # NaN counts as missing
    with held(whole) as data:
        classes = None
        if algo == "Classification":
            classes = sorted(r["_y"] for r in data.select("_y").distinct().collect())
        cuts = _cuts(data, len(xs), max_bins)
        y = F.col("_y")
        if classes is None:
            stats = {"s0": F.lit(1.0), "s1": y, "s2": y * y}
        else:
            stats = {f"s{i}": F.when(y == c, 1.0).otherwise(0.0) for i, c in enumerate(classes)}
        tree = Tree(list(features), classes)
        if classes == []:
            return tree
        with held(_binned(data, cuts, ["_y"])) as binned:
            open_, histogram = [0], _counted(binned, F.lit(0), [0], stats)
            for level in range(max_depth + 1):
                path = scratch_path(spark, "histogram")
                histogram.write.parquet(path)
                histogram = spark.read.parquet(path)
                found = {r["node"]: r for r in _best_splits(histogram, impurity, list(stats)).collect()}
                if level == 0:
                    if not found:
                        return tree
                    tree.add(1, list(found[0]["total"]))
                small, large = [], []
                for i in open_ if level < max_depth else []:
                    best = found[i]["best"]
                    if best is None:
                        continue
                    tree.feature[i], tree.bin[i], tree.gain[i] = best["f"], best["bin"], best["gain"]
                    tree.threshold[i] = cuts[best["f"]][best["bin"]]
                    rest = [t - b for t, b in zip(found[i]["total"], best["below"])]
                    tree.left[i] = tree.add(2 * tree.heap[i], list(best["below"]))
                    right = tree.add(2 * tree.heap[i] + 1, rest)
                    pair = sorted([tree.left[i], right], key=tree.size)
                    small.append(pair[0])
                    large.append((i, *pair))
                if not small:
                    break
                open_ = sorted(small + [c for _, _, c in large])
                fresh = _counted(binned, _node_of_bins(tree), small, stats)
                named = spark.createDataFrame(large, "parent int, small int, large int")
                minus = {s: -F.col(s) for s in stats}
                named = F.broadcast(named)
                parents = histogram.join(named, histogram["node"] == named["parent"]).select(F.col("large").alias("node"), "f", "bin", *stats)
                taken = fresh.join(named, fresh["node"] == named["small"]).select(
                    F.col("large").alias("node"), "f", "bin", *[c.alias(s) for s, c in minus.items()]
                )
                every = fresh.unionByName(parents).unionByName(taken)
                histogram = every.groupBy("node", "f", "bin").agg(*[F.sum(s).alias(s) for s in stats])
    return tree


def node_table(spark, tree: Tree) -> DataFrame:
    """One row per node: ``node`` (heap number), ``feature`` and ``threshold`` of its split or null, ``gain``,
    ``n`` rows and ``prediction``."""
    cells = [
        (h, tree.features[f] if f >= 0 else None, t if f >= 0 else None, g if f >= 0 else None, tree.size(i), tree.value(i))
        for i, (h, f, t, g) in enumerate(zip(tree.heap, tree.feature, tree.threshold, tree.gain))
    ]
    return spark.createDataFrame(cells, "node long, feature string, threshold double, gain double, n double, prediction double")
