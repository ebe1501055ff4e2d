"""Interleaving sources at target weights by Pfair scheduling.

Each source's rows are cut into blocks. With weight ``p / D``, block k (from 0) of a source is
released at slot ``floor(k * D / p)`` and due by ``ceil((k + 1) * D / p)``. Slot by slot the released
block with the earliest deadline is taken. As the weights sum to one, every block meets its deadline:
after t slots a source has had ``t * p / D`` blocks, less or more by under one.

Releases and deadlines repeat every D slots, so only one period is ever worked out, whatever the
number of rows; a row finds its slot by arithmetic on its block's number. When a source runs out,
the schedule starts anew with the weights of those that remain, so no row is left out. With so many
sources or so fine weights that the periods would outgrow the driver, the same schedule is written out
block by block by one task, and rows are joined with it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomstat.llm.tables import row_hash, small
from loomstat.session import scratch_path

# Cells of all period tables together; they are worked out on the driver and sent to every task.
# Above this number the schedule is written out by a task instead.
MAX_CELLS = 4_000_000
LINE_ROWS = 100_000
BUCKET_ROWS = 10_000
# Distinct keys never fill a bucket beyond this multiple of its size; one that is fuller holds a repeated key.
HEAVY = 8


def period(parts: Sequence[int]) -> list[list[int]]:
    """For each source the slots, within one period of ``sum(parts)``, of its blocks. Ties: the first source."""
    total = sum(parts)
    waiting = [(0, i, 0) for i, p in enumerate(parts) if p]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slots: list[list[int]] = [[] for _ in parts]
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // parts[i]), i, k))
        deadline, i, k = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block missed its deadline")
        slots[i].append(t)
        if k + 1 < parts[i]:
            heapq.heappush(waiting, ((k + 1) * total // parts[i], i, k + 1))
    return slots


def phases(parts: Sequence[int], blocks: Sequence[int]) -> list[tuple[int, int, int, int, int, int, list[int]]] | None:
    """The whole schedule: (source, first block, end block, first slot, blocks a period, period, slots).

    None if its periods have more than ``MAX_CELLS`` slots together; ``line`` gives the same schedule.
    """
    used = [p for p, n in zip(parts, blocks) if n]
    # every phase ends one source, so at best the largest leave first
    if sum(accumulate(sorted(used))) > MAX_CELLS * math.gcd(*used):
        return None
    out, done, start = [], [0] * len(parts), 0
    cells = 0
    while True:
        live = [i for i, n in enumerate(blocks) if done[i] < n]
        if not live:
            return out
        divisor = math.gcd(*[parts[i] for i in live])
        own = [parts[i] // divisor for i in live]
        cycle = sum(own)
        cells += cycle
        if cells > MAX_CELLS:
            return None
        slots = period(own)
        left = [blocks[i] - done[i] for i in live]
        end = min((n - 1) // p * cycle + s[(n - 1) % p] for n, p, s in zip(left, own, slots))
        whole, rest = divmod(end + 1, cycle)
        for i, p, s in zip(live, own, slots):
            taken = whole * p + sum(x < rest for x in s)
            out.append((i, done[i], done[i] + taken, start, p, cycle, s))
            done[i] += taken
        start += end + 1


def line(parts: Sequence[int], blocks: Sequence[int]) -> Iterator[tuple[int, int]]:
    """The whole schedule slot by slot: (source, its block), in memory of the sources alone.

    Sources of equal parts share releases and deadlines and take their turns in order, so only their
    group is kept in the heaps, and a start anew costs as much as there are distinct parts.
    """
    groups: dict[int, list[int]] = {}
    for i, (p, n) in enumerate(zip(parts, blocks)):
        if n:
            groups.setdefault(p, []).append(i)
    done = [0] * len(parts)
    total = sum(p * len(own) for p, own in groups.items())
    while groups:
        waiting: list[tuple[int, int, int]] = []  # release, parts, round
        ready = [(-(-total // p), own[0], p, 0, 0) for p, own in groups.items()]  # deadline, source, parts, round, turn
        heapq.heapify(ready)
        t = 0
        while True:
            while waiting and waiting[0][0] <= t:
                _, p, k = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(k + 1) * total // p), groups[p][0], p, k, 0))
            deadline, i, p, k, turn = heapq.heappop(ready)
            yield i, done[i]
            done[i] += 1
            t += 1
            own = groups[p]
            if done[i] == blocks[i]:
                break
            if turn + 1 < len(own):
                heapq.heappush(ready, (deadline, own[turn + 1], p, k, turn + 1))
            else:
                heapq.heappush(waiting, ((k + 1) * total // p, p, k + 1))
        own.pop(turn)
        total -= p
        if not own:
            del groups[p]


def _written_line(spark: SparkSession, jobs: Sequence[tuple[list[int], list[int], list[int], int]]) -> DataFrame:
    """(sid, block, slot) of every block; a job is sources, their parts, their blocks and its first slot."""
    sent = spark.sparkContext.broadcast(jobs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                cells: tuple[list[int], list[int], list[int]] = ([], [], [])
                for chosen, parts, blocks, start in sent.value:
                    for slot, (i, block) in enumerate(line(parts, blocks), start):
                        for column, value in zip(cells, (chosen[i], block, slot)):
                            column.append(value)
                        if len(cells[0]) == LINE_ROWS:
                            yield _batch(cells)
                            cells = ([], [], [])
                yield _batch(cells)

    path = scratch_path(spark, "mixing-line")
    spark.range(0, 1, 1, 1).mapInArrow(work, "sid int, block long, slot long").write.parquet(path)
    return spark.read.parquet(path)


def _batch(cells: Sequence[list[int]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["sid", "block", "slot"])


def fine_resolution(weights: Sequence[float], least: int = 1000, parts: int = 10) -> int:
    """A resolution of ``least`` or more that gives the smallest weight ``parts`` parts."""
    return max(least, math.ceil(parts * sum(weights) / min(weights)))


def integer_parts(weights: Sequence[float], resolution: int = 1000) -> list[int]:
    """Weights as whole parts of about ``resolution``, at least one each, so smaller ones are lifted to one."""
    total = sum(weights)
    return [max(1, round(w / total * resolution)) for w in weights]


def tempered(counts: Sequence[int], power: float = 0.5) -> list[float]:
    """Target weights between the sources' own shares (power 1) and equal ones (power 0)."""
    return [c**power for c in counts]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _cells(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``sid, cell, h, tie`` with cells of bounded size, and the number of rows in each cell.

    A cell, an array that starts with the bucket, is a range of a source's rows in the order of ``h, tie``,
    and cells are in the order of their arrays. One that a repeated key fills is cut by the hash, by ranges
    of the tie, by the tie, and at last, when its rows are equal, by where they were written.
    """
    shift = F.lit(64) - F.ceil(F.log2(F.col("c") / BUCKET_ROWS)).cast("int")
    finer = [F.col("h"), F.expr("shiftright(tie, shift)"), F.col("tie"), F.floor(F.col("n") / BUCKET_ROWS)]
    cut = rows.withColumn("n", F.lit(0).cast("long"))
    for depth, level in enumerate(finer):
        counts = _written(cut.groupBy("sid", "cell").agg(F.count("*").alias("c")), "mixing-cells")
        heavy = counts.filter(F.col("c") > HEAVY * BUCKET_ROWS).select("sid", "cell", shift.alias("shift"))
        found = heavy.count()
        if not found:
            return cut, counts
        if depth == 0:
            cut = _written(rows.withColumn("n", F.monotonically_increasing_id()), "mixing-rows")
        longer = F.concat("cell", F.array(level.cast("long")))
        cut = cut.join(small(heavy, found, 64), ["sid", "cell"], "left")
        cut = cut.withColumn("cell", F.when(F.col("shift").isNull(), F.col("cell")).otherwise(longer)).drop("shift")
    return cut, _written(cut.groupBy("sid", "cell").agg(F.count("*").alias("c")), "mixing-cells")


def mix(
    docs: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = 16,
    resolution: int | None = None,
    row: Column | None = None,
) -> DataFrame:
    """Every row with the slot of its block, its place in the block, and its position in the mix.

    Returns ``row`` (default: key and source) as a struct ``row``, with ``slot``, ``place`` and
    ``position``, which is distinct and rises along the mix. ``weights`` names the target share of
    each source; without it they are tempered row counts, and a source that it leaves out or puts at
    0 follows after all others, by row count. A null source is a source of its own. Within a source
    rows are in the order of the md5 of the key's text, equal keys by a hash of the row. An empty table gives
    no rows; an extra column cannot clash, as it stays within ``row``. Weights are rounded to whole parts
    of ``resolution``, by default 1000 or so many that the smallest weight has ten; with a given
    resolution a source below one part gets one.

    Only counts per source reach the driver. A source of any size is numbered in hash buckets of
    about 10,000 rows, so that none of them meets in one task; a bucket that a repeated key fills is cut
    again, equal rows too.
    """
    spark = docs.sparkSession
    body = row if row is not None else F.struct(F.col(key), F.col(source))
    counts = docs.groupBy(F.col(source).cast("string").alias("s")).agg(F.count("*").alias("c")).collect()
    counts.sort(key=lambda r: (r["s"] is None, r["s"] or ""))
    names, sizes = [r["s"] for r in counts], [r["c"] for r in counts]
    wish = tempered(sizes) if weights is None else [weights.get(s) or 0.0 for s in names]
    blocks = [-(-c // block_rows) for c in sizes]
    plan: list[tuple] | None = []
    jobs = []
    shift = 0
    for chosen in ([i for i, w in enumerate(wish) if w > 0], [i for i, w in enumerate(wish) if not w > 0]):
        if chosen:
            share = [wish[i] if wish[i] > 0 else float(sizes[i]) for i in chosen]
            parts = integer_parts(share, resolution or fine_resolution(share))
            jobs.append((chosen, parts, [blocks[i] for i in chosen], shift))
            steps = phases(*jobs[-1][1:3]) if plan is not None else None
            plan = None if steps is None else plan + [(chosen[i], a, b, t + shift, *rest) for i, a, b, t, *rest in steps]
            shift += sum(blocks[i] for i in chosen)
    bits = [max(0, (max(c, 1) // BUCKET_ROWS)).bit_length() for c in sizes]
    shape = T.StructType([T.StructField("s", T.StringType()), T.StructField("sid", T.IntegerType()), T.StructField("bits", T.IntegerType())])
    ids = F.broadcast(spark.createDataFrame([(s, i, bits[i]) for i, s in enumerate(names)], shape))

    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 15)
    h = F.conv(digits, 16, 10).cast("long")  # 60 bits
    tie = row_hash(docs).alias("tie")
    rows = docs.select(body.alias("row"), F.col(source).cast("string").alias("src"), h.alias("h"), tie)
    known = rows.join(ids, F.col("src").eqNullSafe(F.col("s"))).drop("s", "src")
    # the top bits of the hash cut a source into ranges of hash order
    top = F.floor(F.shiftright("h", 30) / F.pow(F.lit(2.0), 30 - F.col("bits"))).cast("long")
    known, per = _cells(known.select("row", "sid", "h", "tie", F.array(top).alias("cell")))
    before = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("sid", "cell", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("sid", "cell").orderBy("h", "tie", "n"))
    ranked = known.withColumn("r", place).join(starts, ["sid", "cell"])
    ranked = ranked.withColumn("r", F.col("r") - 1 + F.col("before"))
    block = F.floor(F.col("r") / block_rows)
    ranked = ranked.select("row", "sid", block.alias("block"), (F.col("r") % block_rows).cast("int").alias("place"))
    if plan is None:
        placed = ranked.join(_written_line(spark, jobs), ["sid", "block"]).select("row", "slot", "place")
        return placed.withColumn("position", F.col("slot") * block_rows + F.col("place"))
    fields = "sid int, block_from long, block_to long, slot_from long, parts long, cycle long, slots array<int>"
    table = F.broadcast(spark.createDataFrame(plan, fields))
    k = F.col("block") - F.col("block_from")
    slot = F.col("slot_from") + F.floor(k / F.col("parts")) * F.col("cycle")
    slot = slot + F.get("slots", (k % F.col("parts")).cast("int"))
    inside = (F.col("block") >= F.col("block_from")) & (F.col("block") < F.col("block_to"))
    placed = ranked.join(table, "sid").filter(inside).select("row", slot.cast("long").alias("slot"), "place")
    return placed.withColumn("position", F.col("slot") * block_rows + F.col("place"))
