"""0/1 indicators in which a missing value never fires."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_true(*conditions: Column) -> Column:
    """OR of conditions as 0/1, with NULL read as false.

    SQL's three-valued OR would return NULL where the frame logic of the reference
    returns False.
    """
    out = F.lit(False)
    for condition in conditions:
        out = out | F.coalesce(condition, F.lit(False))
    return out.cast("int")


def ordinal(name: str, codes: Mapping[str, int], default: int) -> Column:
    """Map categories to numbers; unknown and NULL take the default."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(F.col(name), F.lit(""))),
                      F.lit(default))


def out_of_range(name: str, low: float, high: float) -> Column:
    """1 when outside the closed range; NULL is not abnormal."""
    return any_true((F.col(name) < low) | (F.col(name) > high))
