"""Expressions over table columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywork.functions import rules


def null_default(value: Column, default: float = rules.MISSING_VALUE_DEFAULT) -> Column:
    return F.coalesce(value, F.lit(default))
