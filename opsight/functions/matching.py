"""Name patterns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def like_any(value: Column, patterns: list[str]) -> Column:
    """SQL LIKE against several patterns; ``%`` any run, ``_`` one character."""
    return any_of([value.like(p) for p in patterns])


def short_name(name: Column) -> Column:
    """The part after the first ``:``; the whole name where there is none."""
    return F.substring(name, F.instr(name, ":") + F.lit(1), F.length(name))


def plain_number(value: Column) -> Column:
    """A number as text, whole values without a decimal part."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
