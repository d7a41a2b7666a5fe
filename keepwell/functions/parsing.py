"""Text-to-type expressions for raw columns. Bad text becomes null, never an error (ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the date and timestamp layouts found in the raw files
DATE_LAYOUTS = ("yyyy-MM-dd", "dd-MM-yyyy")
TIMESTAMP_LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm")
GHOST_PREFIX = "ORD_GHOST_"


def text(name: str) -> Column:
    return F.trim(F.col(name))


def typed(name: str, to: str) -> Column:
    return F.col(name).try_cast(to)


def currency(name: str) -> Column:
    """Number inside a price label such as 'Rs 1,299.00'."""
    return F.regexp_replace(name, "[^0-9.]", "").try_cast("double")


def calendar_date(name: str) -> Column:
    """First date layout that fits. A text whose third character is a dash begins with no year, so the first layout isn't tried
    on it: a layout that doesn't fit costs an exception per value."""
    iso, day_first = (F.try_to_date(F.col(name), layout) for layout in DATE_LAYOUTS)
    return F.coalesce(F.when(F.substring(name, 3, 1) != "-", iso), day_first)


def moment(name: str) -> Column:
    """First timestamp layout that fits, then Spark's own parser."""
    attempts = [F.try_to_timestamp(F.col(name), F.lit(layout)) for layout in TIMESTAMP_LAYOUTS]
    return F.coalesce(*attempts, typed(name, "timestamp"))


def day_of(name: str) -> Column:
    """Date part of an ISO date or timestamp text."""
    return typed(name, "date")


def is_ghost(name: str) -> Column:
    """Reference to an order that does not exist; a missing reference is not a ghost."""
    return F.coalesce(F.col(name).startswith(GHOST_PREFIX), F.lit(False))


def is_zero(amount: Column) -> Column:
    return F.coalesce(amount == 0.0, F.lit(False))


def first_of(*candidates: Column, default=None) -> Column:
    """Reconcile the columns two sources use for one fact."""
    tail = [] if default is None else [F.lit(default)]
    return F.coalesce(*candidates, *tail)


def texts(*names: str) -> list[Column]:
    return [text(n).alias(n) for n in names]


def typed_all(to: str, *names: str) -> list[Column]:
    return [typed(n, to).alias(n) for n in names]


def dates(*names: str) -> list[Column]:
    return [calendar_date(n).alias(n) for n in names]
