"""Casts, labels and thresholds on single numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_cast(text: Column, data_type: str) -> Column:
    """Trim and cast; a cell that does not parse stops the job, in ANSI mode or not."""
    message = F.concat(F.lit(f"not a {data_type}: "), F.coalesce(text, F.lit("NULL")))
    return F.coalesce(F.trim(text).try_cast(data_type), F.raise_error(message).cast(data_type))


def cast_or_default(text: Column, default: float, data_type: str = "double") -> Column:
    """Cast, or ``default`` where the cell is missing or does not parse."""
    return F.coalesce(F.trim(text).try_cast(data_type), F.lit(default).cast(data_type))


def log_label(amount: Column) -> Column:
    """``log(amount + 1)``."""
    return F.log1p(amount)


def implicit_confidence(rating: Column) -> Column:
    """Ratings 1..5 as confidences -1.5..2.5; zero means nothing is known."""
    return rating - F.lit(2.5)


def above(score: Column, cut: float = 0.0) -> Column:
    """1.0 where the score is above the cut; a score on the cut gives 0.0, NULL stays NULL."""
    return (score > F.lit(cut)).cast("double")


def at_least(score: Column, cut: float = 0.5) -> Column:
    """0.0 where the score is below the cut; a score on the cut gives 1.0, NULL stays NULL."""
    return (score >= F.lit(cut)).cast("double")


def clip_unit(score: Column) -> Column:
    """The score moved into [0, 1]."""
    return F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))


def number_text(*numbers: Column) -> Column:
    """Numbers with four decimals, joined with commas."""
    return F.concat_ws(",", *[F.format_string("%.4f", n) for n in numbers])


def clean_zero(number: Column) -> Column:
    """Turn -0.0 into 0.0."""
    return number + F.lit(0.0)


def doubles(values: Iterable[float]) -> Column:
    """A constant array; one literal however long it is, so wide models stay quick to plan."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
