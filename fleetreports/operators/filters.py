"""Stateless row filters (plain Catalyst predicates; no shuffle). The fixed
bounds and codes are in ``fleetreports.defaults``: active is
``isinactive = 'false'`` exactly, north bounds are inclusive, delayed is
strict."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetreports.defaults import ACTIVE_VALUE, NORTH_HIGH, NORTH_LOW, NORTH_WRAP, TRAIN_VTYPE
from fleetreports.schema import REPORT_COLUMNS


def is_active() -> Column:
    return F.col("isinactive") == F.lit(ACTIVE_VALUE)


def is_north(low: float = NORTH_LOW, high: float = NORTH_HIGH, wrap: float = NORTH_WRAP) -> Column:
    b = F.col("bearing")
    # NaN compares false in the source job; Spark orders NaN above every
    # number, so exclude it explicitly.
    return ~F.isnan(b) & ((b >= F.lit(low)) & (b <= F.lit(high)) | (b >= F.lit(wrap)))


def is_train(vtype: int = TRAIN_VTYPE) -> Column:
    return F.col("vtype") == F.lit(vtype)


def is_delayed() -> Column:
    return F.col("delay") > F.lit(0.0)


def same_report(left: str, right: str) -> Column:
    """Two aliased reports are equal: every field, null-safe; ``seq``, the place in
    the feed, does not count."""
    fields = (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in REPORT_COLUMNS if c != "seq")
    return reduce(and_, fields)


def active(reports: DataFrame) -> DataFrame:
    """Reports of active units only (applied before every query)."""
    return reports.filter(is_active())


def north(reports: DataFrame, low: float = NORTH_LOW, high: float = NORTH_HIGH, wrap: float = NORTH_WRAP) -> DataFrame:
    """Units heading north."""
    return reports.filter(is_north(low, high, wrap))


def trains(reports: DataFrame, vtype: int = TRAIN_VTYPE) -> DataFrame:
    return reports.filter(is_train(vtype))


def delayed(reports: DataFrame) -> DataFrame:
    return reports.filter(is_delayed())
