"""Trip expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound in seconds of each delay class, and the open class.
DELAY_CLASSES = [(30, "puntual"), (120, "leve"), (300, "moderado")]
WORST_DELAY_CLASS = "severo"


def delay_category(seconds: Column) -> Column:
    """NULL falls into the open class, like any value above the last bound."""
    (bound, label), *rest = DELAY_CLASSES
    chain = F.when(seconds <= bound, label)
    for bound, label in rest:
        chain = chain.when(seconds <= bound, label)
    return chain.otherwise(WORST_DELAY_CLASS)


def n_stops(origin_order: Column, destination_order: Column) -> Column:
    return F.abs(destination_order - origin_order)


def trip_direction(origin_order: Column, destination_order: Column) -> Column:
    return F.when(destination_order > origin_order, "forward").otherwise("reverse")


def is_transfer(origin_transfer: Column, destination_transfer: Column) -> Column:
    return origin_transfer | destination_transfer


def tagged(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col)


def by_code(code: Column, labels: dict[str, str], default: str) -> Column:
    """Label of a code, with a default for codes not listed."""
    items = list(labels.items())
    chain = F.when(code == items[0][0], items[0][1])
    for key, label in items[1:]:
        chain = chain.when(code == key, label)
    return chain.otherwise(default)


def audit_ts(as_of: Column | str | None = None) -> Column:
    """Load time: the clock, or a given instant so that a run can be repeated exactly."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
