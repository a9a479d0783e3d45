"""Number coercions. All give null for what they cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a stored true.
TRUE_WORDS = ("true", "True", "TRUE", "t", "T", "1", "1.0")


def number(c: Column) -> Column:
    return F.try_cast(c.cast("string"), "double") if hasattr(F, "try_cast") else c.cast("string").try_cast("double")


def decimal(c: Column, digits: int = 2) -> Column:
    """Decimal with ``digits`` places, half to even; a plain cast would round half up."""
    return F.bround(c.cast("string").try_cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})")


def strict_int(c: Column) -> Column:
    """Whole numbers only; a fraction is unreadable."""
    value = F.trim(c.cast("string")).try_cast("double")
    return F.when(value == F.floor(value), value.cast("long"))


def rounded_int(c: Column) -> Column:
    """Nearest integer, half to even."""
    return F.bround(F.trim(c.cast("string")).try_cast("double"), 0).cast("int")


def to_bool(c: Column) -> Column:
    """True for the known spellings of true, else false."""
    return F.coalesce(c.cast("string").isin(*TRUE_WORDS), F.lit(False))


def first_filled(*columns: Column) -> Column:
    """First value that is neither null nor zero; zero when only zeros are left of the last."""
    *first, last = columns
    return F.coalesce(*[F.when(c != 0, c) for c in first], last)


def pages(rows: Column, size: int) -> Column:
    """Number of pages, at least one."""
    return F.greatest(F.lit(1), F.ceil(rows / size)).cast("long")
