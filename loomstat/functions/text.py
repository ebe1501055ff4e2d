"""Splitting text into lines, words and fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A text file's line ends, and line ends or one blank between words.
LINE_END = r"\r\n|\r|\n"
WORD_END = r"[ \r\n]"


def lines(text: Column | str) -> Column:
    """The lines a text reader would give for this text, as an array."""
    return F.split(text, LINE_END)


def words(text: Column | str) -> Column:
    """Words of a whole text: each line split at single blanks. Empty words stay in."""
    return F.split(text, WORD_END)


def utf16_length(text: Column | str) -> Column:
    """Length in UTF-16 units, the length a JVM string has (an emoji counts two)."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def longer_than(word: Column, size: int) -> Column:
    """``utf16_length(word) > size``, encoding only the words where code points cannot decide."""
    points = F.length(word)
    undecided = (points * 2 > size) & (points <= size)
    return F.when(undecided, utf16_length(word) > size).otherwise(points > size)


def fields(line: Column | str, sep: str) -> Column:
    """Split one record at ``sep`` taken literally; empty fields at the end are dropped."""
    line = F.col(line) if isinstance(line, str) else line
    literal = re.escape(sep)
    trimmed = F.regexp_replace(line, f"({literal})+$", "") if len(sep) > 1 else F.rtrim(line, F.lit(sep))
    return F.split(trimmed, literal)
