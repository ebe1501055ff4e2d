"""Preference pairs: the turns that chosen and rejected share once as prompt, the rest masked.

Both conversations of a pair are tables of turns. Their longest common prefix is found without
putting a conversation together: turns are numbered, matched by number, and the least number at which
role or text differ, or one side has ended, is a grouped minimum. Every turn is then rendered by
itself and labelled prompt, chosen or rejected; turns of the prompt are kept from one side only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEARNED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """A turn as training text; null roles and texts count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def numbered(turns: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    """``pair, n, role, text``: turns of each pair numbered from 0 by turn (nulls first), role and text."""
    order = [F.col(c).asc_nulls_first() for c in (turn, role, text)]
    place = F.row_number().over(Window.partitionBy(pair).orderBy(*order)) - 1
    return turns.select(
        F.col(pair).alias("pair"), place.alias("n"), F.col(role).alias("role"), F.col(text).alias("text")
    )


def segments(
    chosen: DataFrame,
    rejected: DataFrame,
    pair: str = "pair_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``pair, part, n, body, learned``: the pair's turns, each once, as prompt, chosen or rejected.

    ``learned`` marks the turns that the loss is taken over: assistant turns that are not in the
    prompt. Rows without a pair are left out, since they belong to nothing; a pair of which one side
    has no turns has an empty prompt and no completion on that side. Other columns are not read.
    """
    sides = [numbered(s.filter(F.col(pair).isNotNull()), pair, turn, role, text) for s in (chosen, rejected)]
    both = sides[0].withColumn("side", F.lit("chosen")).union(sides[1].withColumn("side", F.lit("rejected")))
    # a number is shared if both sides have it with the same role and text
    say = F.struct("role", "text")
    match = both.groupBy("pair", "n").agg(
        F.count("*").alias("c"), F.min(say).alias("lo"), F.max(say).alias("hi")
    )
    differs = (F.col("c") < 2) | ~F.col("lo").eqNullSafe(F.col("hi"))
    last = F.max("n") + 1
    shared = match.groupBy("pair").agg(F.coalesce(F.min(F.when(differs, F.col("n"))), last).alias("shared"))
    placed = both.join(shared, "pair")
    part = F.when(F.col("n") < F.col("shared"), F.lit("prompt")).otherwise(F.col("side"))
    once = placed.filter((F.col("n") >= F.col("shared")) | (F.col("side") == "chosen"))
    return once.select(
        "pair",
        part.alias("part"),
        "n",
        rendered(F.col("role"), F.col("text")).alias("body"),
        ((part != "prompt") & F.coalesce(F.col("role") == LEARNED, F.lit(False))).alias("learned"),
    )


def preference_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    pair: str = "pair_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per pair: prompt, two completions, and the character ranges the loss is taken over.

    Returns ``pair, n_shared, prompt, chosen, rejected, chosen_spans, rejected_spans``; a span is
    ``[start, end)`` in characters of its completion. Everything outside the spans is masked. If one
    conversation is the beginning of the other, its completion is empty; equal ones leave both empty.
    Tables without rows give none. A row of the result holds the two conversations of one pair.
    """
    rows = segments(chosen, rejected, pair, turn, role, text)
    zero = F.lit(0).cast("long")
    so_far = Window.partitionBy("pair", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("body").cast("long")
    ends = rows.withColumn("end", F.sum(size).over(so_far)).withColumn("start", F.col("end") - size)
    turns = ends.groupBy("pair", "part").agg(
        F.sort_array(F.collect_list(F.struct("n", "body", "start", "end", "learned"))).alias("t")
    )
    learned = F.transform(F.filter("t", lambda x: x["learned"]), lambda x: F.struct(x["start"], x["end"]))
    parts = turns.select(
        "pair",
        "part",
        F.array_join(F.transform("t", lambda x: x["body"]), "").alias("body"),
        learned.alias("spans"),
        F.size("t").cast("long").alias("c"),
    )

    def of(part: str, column: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(column)))

    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return parts.groupBy(F.col("pair").alias(pair)).agg(
        F.coalesce(of("prompt", "c"), zero).alias("n_shared"),
        *[F.coalesce(of(p, "body"), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")],
        *[F.coalesce(of(p, "spans"), no_spans).alias(f"{p}_spans") for p in ("chosen", "rejected")],
    )


def with_foreign_endings(
    turns: DataFrame, pair: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", bucket: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides for conversations that come without: another one's last answer.

    Both sides hold the turns up to the last assistant turn. On the rejected side that turn's text is
    the one of the next conversation in the order of the md5 of their keys, within buckets of about
    ``bucket`` conversations (the last takes the first). Conversations without an assistant turn, and
    rows without a key, are on neither side.
    """
    said = turns.filter(F.col(pair).isNotNull() & (F.col(role) == LEARNED))
    answer = F.max(F.struct(F.col(turn).alias("turn"), F.col(text).alias("text"))).alias("a")
    ends = said.groupBy(F.col(pair).alias("pair")).agg(answer)
    ends = ends.withColumn("h", F.md5(F.col("pair").cast("string").cast("binary")))
    number = F.conv(F.substring("h", 1, 13), 16, 10).cast("long")
    dealt = ends.withColumn("bucket", number % max(1, ends.count() // bucket))
    ring = Window.partitionBy("bucket").orderBy("h", "pair")
    first = F.first("a.text").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.row_number().over(ring) == F.count("*").over(Window.partitionBy("bucket"))
    other = F.when(last, first).otherwise(F.lead("a.text").over(ring))
    donors = dealt.select("pair", F.col("a.turn").alias("end"), other.alias("other"))
    joined = turns.select(
        F.col(pair).alias("pair"), F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("x")
    ).join(donors, "pair")
    kept = joined.filter((F.col("t") <= F.col("end")) | F.col("t").isNull())
    answers = (F.col("t") == F.col("end")) & (F.col("r") == LEARNED)
    swapped = F.when(answers, F.col("other")).otherwise(F.col("x"))
    names = [F.col("pair").alias(pair), F.col("t").alias(turn), F.col("r").alias(role)]
    return kept.select(*names, F.col("x").alias(text)), kept.select(*names, swapped.alias(text))
