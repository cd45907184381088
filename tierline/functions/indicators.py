"""Expressions of the published indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.functions import fixed_values as fv
from tierline.functions.casts import to_int


def percentage(numerator: Column, denominator: Column) -> Column:
    """Share in percent to two decimals; null without a usable denominator."""
    share = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)) * 100
    return F.round(share, 2)


def status(value: Column, target: Column) -> Column:
    """Band of the value by its share of the target."""
    reached = value / F.nullif(target.cast("double"), F.lit(0.0)) * 100
    band = F.when(reached.isNull(), fv.STATUS_WITHOUT_TARGET)
    for floor, name in fv.STATUS_BANDS:
        band = band.when(reached >= floor, name)
    return band.otherwise(fv.STATUS_BELOW_BANDS)


def has_committee() -> Column:
    return to_int(F.col("health_services_communityengagement_chc"))
