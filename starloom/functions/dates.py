"""Day numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.values import DAY_ZERO


def day_number_to_iso(days: Column, day_zero: str = DAY_ZERO) -> Column:
    """ISO date text of a number of days since ``day_zero``.

    Fractions round down; NULL and NaN stand for day zero itself.
    """
    known = F.coalesce(F.nanvl(days.cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    return F.date_add(F.lit(day_zero).cast("date"), F.floor(known).cast("int")).cast("string")
