"""Importance class of a version interval.

A closed version gets the coarsest calendar grain with a boundary B such that
``created <= B < deleted`` (both ends are shifted back by one second before
they are truncated, so a version that starts exactly on a boundary counts).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import is_open

# Class codes and the month length in seconds.
SECONDS_PER_MONTH = 2592000
CLASS_OPEN, CLASS_MONTH, CLASS_WEEK, CLASS_DAY, CLASS_HOUR = 0, 1, 5, 30, 720
DEFAULT_MAX_FREQ = 8640          # events per month -> 300 s slots
COARSE_TAIL = 43800              # shown class of anything finer than max_freq

# Display names of the classes.
CLASS_LABELS = {0: "now", 1: "month", 5: "week", 30: "day", 720: "hour", 8640: "5min"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a: Column, b: Column) -> Column:
    """SQL ``div`` on small integers: truncates toward zero, NULL on a NULL divisor."""
    return (a.cast("double") / b.cast("double")).cast("long")


def freq_class(created="created", deleted="deleted", max_freq: int = DEFAULT_MAX_FREQ) -> Column:
    c, d = _c(created), _c(deleted)
    c1 = c - F.expr("INTERVAL 1 SECOND")
    d1 = d - F.expr("INTERVAL 1 SECOND")
    slot = SECONDS_PER_MONTH // max_freq

    def crosses(unit):
        return F.date_trunc(unit, c1) != F.date_trunc(unit, d1)

    def slot_of(x):
        return int_div(F.unix_timestamp(x), F.lit(slot))

    span = (F.unix_timestamp(d) - F.unix_timestamp(c)).cast("long")
    tail = int_div(F.lit(SECONDS_PER_MONTH), F.nullif(span, F.lit(0).cast("long")))
    return (F.when(is_open(d), F.lit(CLASS_OPEN))
            .when(crosses("month"), F.lit(CLASS_MONTH))
            .when(crosses("week"), F.lit(CLASS_WEEK))
            .when(crosses("day"), F.lit(CLASS_DAY))
            .when(crosses("hour"), F.lit(CLASS_HOUR))
            .when(slot_of(c1) != slot_of(d1), F.lit(max_freq))
            .otherwise(tail)).cast("long")


def freq_coarse(freq="freq", max_freq: int = DEFAULT_MAX_FREQ) -> Column:
    """Anything finer than ``max_freq`` (and NULL) is shown as one tail class."""
    f = _c(freq)
    return F.when(f <= max_freq, f).otherwise(F.lit(COARSE_TAIL)).cast("long")


def freq_label(freq="freq", labels: dict | None = None) -> Column:
    labels = labels or CLASS_LABELS
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k).cast("long"), F.lit(v))])
    return m[_c(freq).cast("long")]
