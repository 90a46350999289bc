"""Row conditions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanyard import fixed


def has_prefix(c: Column, prefix: str) -> Column:
    return c.startswith(prefix)


def has_any_prefix(c: Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, [c.startswith(p) for p in prefixes])


def not_test_batch(c: Column) -> Column:
    """Neither a test nor a training batch; a NULL name does not pass."""
    return reduce(and_, [~c.ilike(f"%{word}%") for word in fixed.TEST_WORDS])


def valid_tracking(c: Column) -> Column:
    """A real shipment number: present, not blank, not the placeholder."""
    return c.isNotNull() & (F.rtrim(c) != "") & (F.rtrim(c) != fixed.DUMMY_TRACKING)


def in_tracked_stage(step: Column, location: Column) -> Column:
    """Inside one of the stages the inventory has a column for."""
    anywhere = [s for _, s, at in fixed.INVENTORY_STAGES if at is None]
    fixed_place = [(step == s) & (location == at)
                   for _, s, at in fixed.INVENTORY_STAGES if at is not None]
    return reduce(or_, fixed_place, step.isin(anywhere))


def is_nonworking(day_name: Column, description: Column) -> Column:
    """A weekend day, or any day the calendar gives a name to."""
    return day_name.isin("Saturday", "Sunday") | description.isNotNull()
