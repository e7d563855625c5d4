"""Evaluating a costly column once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns so that later filters on them do not repeat their computation.

    Spark moves a filter below the projection that computes its column and copies the expression
    into the filter, and once more for each further reference: a filter on a parsed document parses
    its text again. A one-element ``inline`` keeps the row count, runs inside whole-stage codegen,
    and filters on its output stay above it.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*df.columns, F.inline(F.array(row)))
