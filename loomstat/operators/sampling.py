"""Splits and per-step samples that do not depend on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HEX_DIGITS = 13
BUCKETS = 1 << (4 * HEX_DIGITS)


def key_bucket(*key: Column) -> Column:
    """A number in [0, 2**52) taken from the first 13 md5 digits of the key's text."""
    text = F.concat_ws(":", *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("long")


def in_share(share: float, *key: Column) -> Column:
    """True for about this share of the keys, always for the same ones; any share down to 2e-16."""
    return key_bucket(*key) < F.lit(round(share * BUCKETS)).cast("long")


def split_by_key(df: DataFrame, key: str | Sequence[str], share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; all rows of a key fall on the same side, in every run.

    Several key columns make one key: name more of them where one value holds many rows.
    """
    chosen = in_share(share, *[F.col(k) for k in ([key] if isinstance(key, str) else key)])
    return df.filter(chosen), df.filter(~chosen)


def random_split(df: DataFrame, share: float = 0.8, seed: int | None = None) -> list[DataFrame]:
    """Row-wise random split; repeatable only with a seed and unchanged partitions."""
    return df.randomSplit([share, 1.0 - share], seed)


SELECT_BITS = 10  # each pass over the hashes splits the open range of a class into 2**10 parts
SELECT_ROWS = 4096  # a range of at most so many rows per class is fetched and cut exactly


def bottom_k(
    df: DataFrame,
    key: str | Sequence[str],
    k: int | dict,
    by: str | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Exactly ``k`` rows per value of ``by`` (all rows where there are fewer): those with the least
    ``(key_bucket(key), tie)``, the same ones in every run and under every partitioning.

    ``k`` may be a dictionary from class to size; classes that it does not name get no rows. Null is a
    class like any other. Without ``by`` the table is one class. Rows that agree on key and ``tie`` are
    interchangeable, and as many of them are taken as are missing.

    No class is gathered in one task: every pass counts the open hash range of each class in parts,
    which are combined before the shuffle, and goes on with the part that holds the k-th row. At the
    end at most ``SELECT_ROWS`` rows per class are looked at one by one; only many rows of one hash
    are more than that, and these are cut by ``tie`` alone. A class adds a row per part to the driver.
    """
    bucket = key_bucket(*[F.col(c) for c in ([key] if isinstance(key, str) else key)])
    rows = df.select(F.struct("*").alias("_row"), bucket.alias("_h"), (F.col(by) if by else F.lit(0)).alias("_by"))
    rows = rows.withColumns({f"_t{i}": F.col(f"_row.{t}") for i, t in enumerate(tie)})
    classes = [r["_by"] for r in rows.select("_by").distinct().collect()]
    wanted = {c: k.get(c, 0) if isinstance(k, dict) else k for c in classes}
    # class -> first and last hash of the open range, and how many rows of it are still wanted
    open_ = {c: (0, BUCKETS - 1, size) for c, size in wanted.items() if size > 0}
    cuts = []
    while open_:
        counts, following = _range_counts(rows, open_), {}
        for c, (first, last, size) in open_.items():
            here, width = sorted(counts.get(c, [])), _part_width(first, last)
            if sum(n for _, n in here) <= size:  # everything up to the end of the range
                cuts.append((c, last + 1, last + 1, 0))
                continue
            before = 0
            for part, n in here:
                if before + n >= size:
                    break
                before += n
            low = first + part * width
            high = min(last, low + width - 1)
            if n <= SELECT_ROWS or low == high:
                cuts.append((c, low, high, size - before))
            else:
                following[c] = (low, high, size - before)
        open_ = following
    cut = _by_class(rows, cuts, "_low long, _high long, _size long")
    taken = cut.filter(F.col("_h") < F.col("_low"))
    order = Window.partitionBy("_by").orderBy("_h", *[f"_t{i}" for i in range(len(tie))])
    edge = cut.filter(F.col("_h").between(F.col("_low"), F.col("_high"))).withColumn("_n", F.row_number().over(order))
    return taken.select("_row.*").unionAll(edge.filter(F.col("_n") <= F.col("_size")).select("_row.*"))


def _by_class(rows: DataFrame, cells: list[tuple], columns: str) -> DataFrame:
    """Rows beside the cells of their class; classes without cells are left out."""
    kind = rows.schema["_by"].dataType.simpleString()
    known = F.broadcast(rows.sparkSession.createDataFrame(cells, f"_own {kind}, {columns}"))
    return rows.join(known, F.col("_by").eqNullSafe(F.col("_own")))


def _part_width(first: int, last: int) -> int:
    return max(1, -(-(last - first + 1) // (1 << SELECT_BITS)))


def _range_counts(rows: DataFrame, open_: dict) -> dict[object, list[tuple[int, int]]]:
    """Per class: how many rows each part of its open range holds."""
    ranges = [(c, first, last, _part_width(first, last)) for c, (first, last, _) in open_.items()]
    inside = _by_class(rows.select("_by", "_h"), ranges, "_first long, _last long, _width long")
    inside = inside.filter(F.col("_h").between(F.col("_first"), F.col("_last")))
    found: dict[object, list[tuple[int, int]]] = {}
    for r in inside.groupBy("_by", F.expr("(_h - _first) div _width").alias("part")).agg(F.count("*").alias("n")).collect():
        found.setdefault(r["_by"], []).append((r["part"], r["n"]))
    return found
