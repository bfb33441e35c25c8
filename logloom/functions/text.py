"""Cutting fields out of a raw text line.

Each function returns ``''`` for a field that is not there. On large inputs the regular expressions are nearly
all of the work of a text scan, so they see as little text as possible: the header patterns only the first 19
characters, the others only lines in which a plain substring search finds what they need.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions import fixed


def quoted(word: str) -> str:
    """A pattern that matches just this word; a backslash before anything but a letter or digit makes it literal."""
    return "".join(char if char.isalnum() else f"\\{char}" for char in word)


def any_of(words: Sequence[str]) -> str:
    """A pattern for one of the words, the first listed that fits."""
    if not words or not all(words):
        raise ValueError("the list of words is empty or has an empty word")
    return "|".join(map(quoted, words))


def leading_date(line: Column) -> Column:
    return F.regexp_extract(F.substring(line, 1, fixed.STAMP_WIDTH), fixed.DATE_PATTERN, 1)


def leading_time(line: Column) -> Column:
    return F.regexp_extract(F.substring(line, 1, fixed.STAMP_WIDTH), fixed.TIME_PATTERN, 1)


def word_after_comma(line: Column, words: Sequence[str]) -> Column:
    """First of ``words`` that directly follows a comma and optional blanks, anywhere in the line."""
    return F.regexp_extract(line, rf",\s*({any_of(words)})", 1)


def first_word(line: Column, words: Sequence[str]) -> Column:
    """First of ``words`` to appear anywhere in the line.

    Only a line that holds several of them needs the regular expression to tell which comes first.
    """
    pattern = any_of(words)
    pattern = f"{_starts(words)}({pattern})"
    found = {word: line.contains(word) for word in words}
    how_many = reduce(lambda total, one: total + one, [one.cast("int") for one in found.values()])
    only = F.coalesce(*[F.when(present, F.lit(word)) for word, present in found.items()])
    several = F.regexp_extract(line, pattern, 1)
    return F.when(how_many == 0, F.lit("")).when(how_many == 1, only).otherwise(several)


def text_after_word(line: Column, words: Sequence[str]) -> Column:
    """Rest of the line behind the first of ``words`` that is followed by blanks."""
    pattern = any_of(words)
    rest = F.regexp_extract(line, rf"{_starts(words)}(?:{pattern})\s+(.*)", 1)
    return F.when(_holds_any(line, words), rest).otherwise(F.lit(""))


def first_number(field: Column) -> Column:
    """First run of digits with optional decimals, as double; null when there is none. Signs are ignored."""
    return F.regexp_extract(field, fixed.NUMBER_PATTERN, 0).try_cast("double")


def shorten(text: Column, width: int = fixed.TEMPLATE_WIDTH) -> Column:
    """At most ``width`` characters; a longer text ends in three dots."""
    cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
    return F.when(F.length(text) <= width, text).otherwise(cut)


def _holds_any(line: Column, words: Sequence[str]) -> Column:
    return reduce(lambda left, right: left | right, [line.contains(word) for word in words])


def _starts(words: Sequence[str]) -> str:
    """Look-ahead for the possible first characters: skips most positions without trying each word."""
    return f"(?=[{''.join(map(quoted, sorted({word[0] for word in words})))}])"
