"""Which documents have nearly the same n-gram set: a blocked sparse product of the incidence matrix.

Rows are documents, columns are n-grams, and the product of the matrix with its transpose holds the
overlap of every pair. Only entries that reach a bound are wanted: a Jaccard index of t needs an
overlap of ``t / (1 + t) * (|x| + |y|)``, and sizes within a factor of t.

* Equal sets are one row. A row is known by its size and a 128-bit sum over its hashed n-grams.
* Columns are ordered from rare to frequent (a sketch of column counts, exact hashes for ties). Of a
  row with n entries only the first ``n - ceil(t * n) + 1`` columns can be the first that two similar
  rows share: these columns are the first block of the product, one posting list each.
* In each list every row meets the list's first row (the one with the fewest rarer columns); a pair
  is dropped if what both have left after this column cannot reach the bound. For the others the
  second block, all columns of the two rows, gives the exact overlap. This links each list's star.
  Before the rows are fetched, parities of each row's columns (1024 bits, more for long rows) are
  compared: two rows differ in at least as many columns as parities, which rules out nearly all pairs
  that only share a passage.
* A second round takes the lists whose rows are still in different components, and multiplies only
  across components. After it every pair over the threshold is linked or already connected, so the
  components are exact, and a group of m near copies costs about m products, not m * m.

Long lists are cut into parts of bounded size, by the counts known from the sketch above its typical
cell; the parts' first rows are then joined the same way, and the second round meets part by part.
Everything that is used twice is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomstat.llm.components import components
from loomstat.llm.tables import row_hash, small
from loomstat.llm.words import mixed, shingle_hashes, slices, word_hashes
from loomstat.session import scratch_path

SKETCH = 1 << 18
LIST_ROWS = 100_000
SEEN_SETS = 200_000
BITMAP_BITS = 1 << 22
_OWN_AND_NEXT = (np.uint64(0), np.uint64(1 << 48))

Grams = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def word_shingles(size: int) -> Grams:
    """Hashes of the runs of ``size`` words, A-Z lower-cased; fewer words make one shingle."""

    def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, counts = word_hashes(texts, lower=True)
        return shingle_hashes(words, counts, size)

    return grams


def gram_sets(texts: pa.Array, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of all texts, where each text's begin, and two numbers that name each set."""
    values, first = grams(texts)
    sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    names = []
    for salt in (0xA5A5A5A5A5A5A5A5, 0x3C3C3C3C3C3C3C3C):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(flat ^ np.uint64(salt)), dtype=np.uint64)])
        names.append((sums[begins[1:]] - sums[begins[:-1]]).view(np.int64))
    return flat, begins, names[0], names[1]


def _sets(batch: pa.RecordBatch, grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The sets of a batch as ``gram_sets`` gives them: of its texts, or of written hashes beside their names."""
    column = batch.column(0)
    for i, j in slices(column):
        part = column.slice(i, j - i)
        if batch.num_columns == 1:
            yield gram_sets(part, grams)
            continue
        n = pc.list_value_length(part).to_numpy(zero_copy_only=False)
        a, b = (batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in (1, 2))
        flat = part.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        yield flat, np.concatenate([[0], np.cumsum(n)]).astype(np.int64), a, b


def _lists(flat: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(flat.view(np.int64)))


def parities(flat: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Each set's parity bits as longs: whether an odd number of its hashes fall on each bit.

    There are 1024 bits, doubled until they are half as many as the hashes. Halves of a longer row
    of bits, combined by XOR, are the bits of half the length.
    """
    n = np.diff(begins)
    longs = 16 << np.ceil(np.log2(np.maximum(n / 2048, 1))).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(longs)])
    width = np.repeat((longs * 64 - 1).astype(np.uint64), n)
    cell = np.repeat(ends[:-1] * 64, n) + (mixed(flat) & width).astype(np.int64)
    odd = (np.bincount(cell, minlength=ends[-1] * 64) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.packbits(odd).view(np.int64)))


def _folded(bits: str, longs: Column) -> Column:
    """Parity bits at the length of the shorter of two rows, whose lengths differ twofold at most."""
    halves = F.zip_with(F.slice(bits, F.lit(1), longs), F.slice(bits, longs + 1, longs), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) == longs, F.col(bits)).otherwise(halves)


def _bucket(flat: np.ndarray) -> np.ndarray:
    return (flat & np.uint64(SKETCH - 1)).astype(np.int64)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def length_bands(n: np.ndarray, percent: int) -> np.ndarray:
    """The band of each set length: a set and any one similar to it are in the same or neighbouring bands.

    A band ends at the greatest length that its least length can be similar to.
    """
    edges = [1]
    while edges[-1] <= n.max(initial=0):
        edges.append(edges[-1] * 100 // percent + 1)
    return np.searchsorted(np.array(edges), n, "right")


def list_parts(counts: np.ndarray, typical: float) -> np.ndarray:
    """Into how many parts the lists with these sketch counts are cut.

    A cell counts its column and all others that fall on it, which the typical cell tells: however large
    the table, only columns that stand out are cut.
    """
    return np.maximum(1, np.ceil((counts - typical) / LIST_ROWS)).astype(np.int64)


def _room(least: str | Column, percent: int) -> Column:
    """Whether what is left of a row (size n, place p) can match a row of this size, or of the least fitting one."""
    least = F.col(least) if isinstance(least, str) else least
    n = F.col("n")
    size = n * 100 + F.greatest(least * 100, n * percent)
    return (n - F.col("p")) * (100 + percent) * 100 >= size * percent


def _fits(percent: int) -> Column:
    """Whether two rows that meet at a column (x, y: size n and place p) can still reach the bound."""
    nx, ny = F.col("x.n"), F.col("y.n")
    sizes = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    rest = F.least(nx - F.col("x.p"), ny - F.col("y.p"))
    return sizes & (rest * (100 + percent) >= (nx + ny) * percent)


class SimilarSets:
    """The steps of one join over ``docs``: sets, posting lists, links and components.

    With ``banded`` sets there is a list per column and band of set lengths. A set is listed in its
    own band and the next, so two similar sets share one, and a frequent column is many lists.

    With ``stored`` the hashes of every set are written in the first pass, and the others read these and
    not the texts: for n-grams that take more time to find, and less room, than the words.
    """

    def __init__(
        self, docs: DataFrame, keep: dict[str, Column], text: Column, grams: Grams, percent: int,
        banded: bool = False, stored: bool = False,
    ):
        if not 50 < percent <= 100:
            raise ValueError("the threshold is a whole percentage above 50")
        self.docs, self.text, self.grams, self.percent, self.banded, self.stored = docs, text, grams, percent, banded, stored
        self.spark = docs.sparkSession
        self.keep = list(keep)
        found, self.weights = self._describe(keep)
        self.rows = found.select("k", "n", "a", "b", "bits")
        self.source = found.select("s", "a", "b") if stored else docs.select(text.alias("t"))

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"jaccard-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _describe(self, keep: dict[str, Column]) -> tuple[DataFrame, np.ndarray]:
        """One pass: size and name of every row's set, and how many sets touch each sketch bucket."""
        grams, stored = self.grams, self.stored
        texts = self.docs.select(F.struct(*[c.alias(n) for n, c in keep.items()]).alias("k"), self.text.alias("t"))
        fields = [texts.schema["k"], *[T.StructField(n, T.LongType()) for n in ("n", "a", "b", "bucket", "count")]]
        fields += [T.StructField(n, T.ArrayType(T.LongType())) for n in (("bits", "s") if stored else ("bits",))]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, kind = np.zeros(SKETCH, np.int64), None
            for batch in batches:
                kept, column = batch.column(0), batch.column(1)
                kind = kept.type
                for i, j in slices(column):
                    flat, begins, a, b = gram_sets(column.slice(i, j - i), grams)
                    counts += np.bincount(_bucket(flat), minlength=SKETCH)
                    none = pa.nulls(j - i, pa.int64())
                    more = [parities(flat, begins), *([_lists(flat, begins)] if stored else [])]
                    yield _batch([kept.slice(i, j - i), np.diff(begins), a, b, none, none, *more], schema)
            at = np.flatnonzero(counts)
            if kind is not None and len(at):
                none = pa.nulls(len(at), pa.int64())
                more = [pa.nulls(len(at), pa.list_(pa.int64()))] * (2 if stored else 1)
                yield _batch([pa.nulls(len(at), kind), none, none, none, at, counts[at], *more], schema)

        found = self._written(texts.mapInArrow(run, schema), "sets")
        weights = np.zeros(SKETCH, np.int64)
        summed = found.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("count").alias("c"))
        for r in summed.collect():  # at most one row per bucket
            weights[r["bucket"]] = r["c"]
        return found.filter(F.col("bucket").isNull()), weights

    def _entries(self) -> DataFrame:
        """First-block entries of every distinct set: column, list part, place p, size and name."""
        sent = self.spark.sparkContext.broadcast(self.weights)
        typical = float(np.median(self.weights))
        grams, percent, banded = self.grams, self.percent, self.banded
        schema = T.StructType([T.StructField(n, T.LongType()) for n in ("g", "part", "parts", "p", "n", "a", "b")])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, seen = sent.value, set()
            for batch in batches:
                for flat, begins, a, b in _sets(batch, grams):
                    n = np.diff(begins)
                    bands = length_bands(n, percent).astype(np.uint64) << np.uint64(48)
                    out = []
                    for d in np.flatnonzero(n):
                        name = (int(a[d]), int(b[d]))
                        if name in seen:  # a copy; forgetting some names would only repeat entries
                            continue
                        if len(seen) < SEEN_SETS:
                            seen.add(name)
                        own = flat[begins[d] : begins[d + 1]]
                        weight = weights[_bucket(own)]
                        order = np.lexsort((own, weight))[: prefix_length(n[d : d + 1], percent)[0]]
                        parts = list_parts(weight[order], typical)
                        part = (np.uint64(a[d].view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
                        rest = [np.full(len(order), v, np.int64) for v in (n[d], a[d], b[d])]
                        place = np.arange(len(order))
                        lists = [mixed(own[order] ^ (bands[d] + k)) for k in _OWN_AND_NEXT] if banded else [own[order]]
                        out += [[g.view(np.int64), part, parts, place, *rest] for g in lists]
                    if out:
                        yield _batch([np.concatenate(c) for c in zip(*out)], schema)

        return self.source.mapInArrow(run, schema)

    def _postings(self) -> DataFrame:
        """Lists of rows that may have a partner: each row ``x`` beside the first row ``y`` of its list.

        In order of size, a row needs a neighbour before it within the threshold's factor, or one after
        it, that what is left of the row past this column can still match; else it has no partner in
        the list. The least size that can stand before it is the list's least, so in a list of rows of
        one size those whose place is too late for each other all go. Most lists of rows that share a
        passage end here. Of a long list only the least size of all its parts is known, and rows that
        cannot match this or the least fitting size go.
        """
        by_size = Window.partitionBy("g", "part").orderBy("n", "a", "b")
        same = (F.lag("a").over(by_size) == F.col("a")) & (F.lag("b").over(by_size) == F.col("b"))
        once = self._entries().withColumn("same", same).filter(~F.coalesce("same", F.lit(False))).drop("same")
        before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
        whole = Window.partitionBy("g", "part")
        n, t = F.col("n"), self.percent
        ahead = (before * 100 >= n * t) & _room(F.min("n").over(whole), t)
        beside = ahead | ((n - F.col("p")) * (100 + t) >= (n + after) * t)
        some = once.withColumn("beside", (F.col("parts") > 1) | F.coalesce(beside, F.lit(False))).filter("beside")
        row = F.struct("p", "n", "a", "b")
        first = F.min(row).over(whole)
        lists = self._written(some.select("g", "part", "parts", row.alias("x"), first.alias("y")), "lists")
        long = lists.filter(F.col("parts") > 1)
        least = long.groupBy("g").agg(F.min("x.n").alias("least"))
        long = long.join(small(least, least.count(), 32), "g").select(*lists.columns, "x.n", "x.p", "least")
        return lists.filter(F.col("parts") == 1).union(long.filter(_room("least", t)).select(*lists.columns))

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (xa, xb, ya, yb) that sizes and parities do not rule out."""
        ends = [pairs.select(F.col(f"{e}a").alias("a"), F.col(f"{e}b").alias("b")) for e in "xy"]
        ends = self._written(ends[0].union(ends[1]).distinct(), "ends")
        marks = self.rows.join(small(ends, ends.count(), 48), ["a", "b"], "left_semi")
        marks = marks.select("a", "b", "n", "bits").dropDuplicates(["a", "b"])
        left, right = ([F.col(c).alias(f"{e}{c}") for c in ("a", "b", "n", "bits")] for e in "xy")
        both = pairs.join(marks.select(*left), ["xa", "xb"]).join(marks.select(*right), ["ya", "yb"])
        longs = F.least(F.size("xbits"), F.size("ybits"))
        sides = _folded("xbits", longs), _folded("ybits", longs)
        apart = F.zip_with(*sides, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long"))
        apart = F.aggregate(apart, F.lit(0).cast("long"), lambda total, n: total + n)
        size = F.col("xn") + F.col("yn")
        # the overlap is at most (size - apart) / 2
        fits = (size - apart) * (100 + self.percent) >= size * 2 * self.percent
        return both.filter(fits).select(*pairs.columns)

    def _exact(self, met: DataFrame) -> DataFrame:
        """The pairs (xa, xb, ya, yb) whose whole rows overlap enough."""
        pairs = self._written(self._possible(met), "possible")
        ends = [pairs.select(F.col(f"{e}a").alias("a"), F.col(f"{e}b").alias("b")) for e in "xy"]
        names = self._written(ends[0].union(ends[1]).distinct(), "names")
        count = names.count()
        if not count:
            return pairs
        wanted = self.spark.sparkContext.broadcast(_bitmap(names))
        grams = self.grams
        schema = T.StructType([T.StructField(n, T.LongType()) for n in "ab"] + [T.StructField("s", T.ArrayType(T.LongType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = set()
            for batch in batches:
                for flat, begins, a, b in _sets(batch, grams):
                    bit = np.mod(a, BITMAP_BITS)
                    ok = (np.diff(begins) > 0) & ((wanted.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0)
                    rows = []
                    for d in np.flatnonzero(ok):
                        name = (int(a[d]), int(b[d]))
                        if name not in seen:
                            rows.append(d)
                            if len(seen) < SEEN_SETS:
                                seen.add(name)
                    if rows:
                        sets = [flat[begins[d] : begins[d + 1]].view(np.int64) for d in rows]
                        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                        yield _batch([a[rows], b[rows], _lists(np.concatenate(sets), ends)], schema)

        found = self.source.mapInArrow(run, schema)
        found = found.join(small(names, count, 48), ["a", "b"], "left_semi")
        sets = self._written(found.dropDuplicates(["a", "b"]), "rows")
        left = sets.select(F.col("a").alias("xa"), F.col("b").alias("xb"), F.col("s").alias("xs"))
        right = sets.select(F.col("a").alias("ya"), F.col("b").alias("yb"), F.col("s").alias("ys"))
        both = pairs.join(left, ["xa", "xb"]).join(right, ["ya", "yb"])
        overlap = F.size(F.array_intersect("xs", "ys"))
        union = F.size("xs") + F.size("ys") - overlap
        return both.filter(overlap * 100 >= union * self.percent).select(*pairs.columns)

    def links(self) -> DataFrame:
        """Links ``(u, v)`` of set names that connect exactly the sets that similar pairs connect."""
        lists = self._postings()
        heads = lists.filter(F.col("parts") > 1).select("g", F.col("y").alias("x")).distinct()
        order = Window.partitionBy("g").orderBy("x.p", "x.n", "x.a", "x.b")
        across = heads.select("x", F.first("x").over(order).alias("y"))
        stars = lists.select("x", "y").union(across).filter(_fits(self.percent))
        first = self._written(_pairs(stars), "stars")
        found = self._written(_as_links(self._exact(first)), "links1")
        tree = components(found)

        home = tree.select(F.col("u.a").alias("ua"), F.col("u.b").alias("ub"), F.col("v").alias("home"))
        home = small(home, home.count(), 64)
        own = F.struct(F.col("x.a").alias("a"), F.col("x.b").alias("b"))
        placed = lists.select("g", "part", "parts", "x").join(
            home, (F.col("x.a") == F.col("ua")) & (F.col("x.b") == F.col("ub")), "left"
        )
        placed = placed.select("g", "part", "parts", "x", F.coalesce("home", own).alias("home"))
        dealt = self._written(_with_main(placed), "mixed")
        minor = dealt.filter(F.col("home") != F.col("main"))
        # each part of a list meets each other part, so a long list is as many tasks as it has part pairs
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        one = minor.select("g", F.col("part").alias("xpart"), others.alias("ypart"), "x", F.col("home").alias("hx"))
        big = (F.col("home") == F.col("main")).alias("big")
        two = dealt.select("g", others.alias("xpart"), F.col("part").alias("ypart"), F.col("x").alias("y"), F.col("home").alias("hy"), big)
        # two minor rows meet once, from the lesser component; a main row meets every minor row
        met = one.join(two, ["g", "xpart", "ypart"]).filter(F.col("big") | (F.col("hx") < F.col("hy"))).filter(_fits(self.percent))
        more = _pairs(met).join(first, ["xa", "xb", "ya", "yb"], "left_anti")
        second = self._written(more, "across")
        late = _as_links(self._exact(second))
        return found.union(late)

    def components(self) -> DataFrame:
        """Every row's ``k`` columns, its set's size ``n`` and name, and its component's least ``rank``.

        ``rank`` must be one of the kept columns; rows with an empty set have no component.
        """
        tree = components(self._written(self.links(), "links"))
        home = tree.select(F.col("u.a").alias("ua"), F.col("u.b").alias("ub"), F.col("v").alias("home"))
        home = small(home, home.count(), 64)
        placed = self.rows.join(home, (F.col("a") == F.col("ua")) & (F.col("b") == F.col("ub")), "left")
        own = F.struct("a", "b")
        name = F.when(F.col("n") > 0, F.coalesce("home", own))
        placed = placed.select("k", "n", name.alias("home"))
        least = placed.filter(F.col("home").isNotNull()).groupBy("home").agg(F.min("k.rank").alias("least"), F.count("*").alias("c"))
        # only components of several rows are looked up, from a table that is sent or joined in split parts
        least = self._written(least.filter(F.col("c") > 1).drop("c"), "least")
        found = placed.join(small(least, least.count(), 96), "home", "left")
        alone = F.when(F.col("home").isNotNull(), F.col("k.rank"))
        return found.select("k.*", "n", F.coalesce("least", alone).alias("least"))


def _batch(columns: Sequence, schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema.fieldNames())


def _bitmap(names: DataFrame) -> np.ndarray:
    """A bit per remainder of the names: most sets that nobody asks for are told by it and not built.

    Of any number of names the driver gets this fixed number of bits; the join on names decides.
    """
    bit = F.pmod("a", F.lit(BITMAP_BITS))
    cells = names.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(a, {BITMAP_BITS}) % 64 as int))").alias("v"))
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in cells.groupBy("w").agg(F.bit_or("v").alias("v")).collect():
        out[r["w"]] = r["v"]
    return out.view(np.uint64)


def _with_main(placed: DataFrame) -> DataFrame:
    """The rows of lists with more than one ``home``, and ``main``, the home of most of a list's rows.

    The rows of the main component meet the others only, never each other. A list in one part is of
    bounded size, and its rows meet in a window; a list in several parts is counted first.
    """
    of_list, of_home = Window.partitionBy("g"), Window.partitionBy("g", "home")
    short = placed.filter(F.col("parts") == 1).withColumns(
        {"lo": F.min("home").over(of_list), "hi": F.max("home").over(of_list)}
    )
    short = short.filter(F.col("lo") != F.col("hi")).withColumn("c", F.count("*").over(of_home))
    main = F.max(F.struct("c", "home")).over(of_list)["home"]
    short = short.select("g", "part", "parts", "x", "home", main.alias("main"))
    long = placed.filter(F.col("parts") > 1)
    counts = long.groupBy("g", "home").agg(F.count("*").alias("c"))
    largest = counts.groupBy("g").agg(F.max(F.struct("c", "home"))["home"].alias("main"), F.count("*").alias("homes"))
    largest = largest.filter(F.col("homes") > 1).drop("homes")
    return short.union(long.join(largest, "g").select("g", "part", "parts", "x", "home", "main"))


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs of different sets, each once."""
    x, y = F.struct("x.a", "x.b"), F.struct("y.a", "y.b")
    less, more = F.least(x, y), F.greatest(x, y)
    both = met.filter(x != y).select(less.alias("l"), more.alias("m"))
    return both.select(
        F.col("l.a").alias("xa"), F.col("l.b").alias("xb"), F.col("m.a").alias("ya"), F.col("m.b").alias("yb")
    ).distinct()


def _as_links(pairs: DataFrame) -> DataFrame:
    u = F.struct(F.col("xa").alias("a"), F.col("xb").alias("b"))
    v = F.struct(F.col("ya").alias("a"), F.col("yb").alias("b"))
    return pairs.select(u.alias("u"), v.alias("v"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """``(key, n_shingles, component_id)`` of every row; the component's least key, its own included.

    Rows without a word (null and empty texts) are linked with nothing: their component is their own
    key. Rows may repeat keys or be equal; each gives a row. Null keys are no candidates for the
    least, so a component of null keys only has none. Other columns are not read.
    """
    join = SimilarSets(docs, {"rank": F.col(key)}, F.col(text), word_shingles(size), percent)
    found = join.components()
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("rank"))
    return found.select(F.col("rank").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with one row left of every group of similar texts.

    It is the one with the least key (nulls last), then the least hash of its columns; of rows equal
    in all columns one stays too. Rows without a word form no groups and all stay.
    """
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), row_hash(docs).alias("print"))
    join = SimilarSets(docs, {"rank": rank}, F.col(text), word_shingles(size), percent)
    found = join._written(join.components(), "groups")
    lost = found.filter((F.col("n") > 0) & (F.col("rank") != F.col("least"))).select("rank").distinct()
    twice = found.filter((F.col("n") > 0) & (F.col("rank") == F.col("least")))
    twice = twice.groupBy("rank").agg(F.count("*").alias("c")).filter(F.col("c") > 1).select("rank")
    rows = docs.select(F.struct("*").alias("row"), rank.alias("rank"))
    lost, repeated = join._written(lost, "lost"), join._written(twice, "twice")
    kept = rows.join(small(lost, lost.count(), 48), "rank", "left_anti")
    if repeated.count():
        again = kept.join(repeated, "rank", "left_semi").dropDuplicates(["rank"])
        kept = kept.join(repeated, "rank", "left_anti").union(again)
    return kept.select("row.*")
