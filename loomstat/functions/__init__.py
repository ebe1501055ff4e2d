"""Column expressions; everything here stays inside the JVM."""

from loomstat.functions.numbers import (
    above,
    at_least,
    cast_or_default,
    clip_unit,
    clean_zero,
    doubles,
    implicit_confidence,
    log_label,
    number_text,
    strict_cast,
)
from loomstat.functions.text import fields, lines, utf16_length, words

__all__ = [
    "above",
    "at_least",
    "cast_or_default",
    "clean_zero",
    "clip_unit",
    "doubles",
    "fields",
    "implicit_confidence",
    "lines",
    "log_label",
    "number_text",
    "strict_cast",
    "utf16_length",
    "words",
]
