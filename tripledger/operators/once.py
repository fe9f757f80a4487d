"""Columns that are computed once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``rows.withColumns(columns)``, with a border the optimizer copies no expression across.

    Spark replaces a derived column by its expression wherever a later filter or projection uses it, so
    a distance used in six rules is computed six times and the generated method outgrows what the JVM
    compiles. Behind the expansion of a list of one row the values are plain fields: filters on them stay
    above, and each expression is evaluated and compiled once. Columns nobody uses are computed as well,
    so put here what is used more than once.
    """
    kept = [c for c in rows.columns if c not in columns]
    one = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return rows.select(*kept, F.inline(one)).select(
        *rows.columns, *[c for c in columns if c not in rows.columns])


def settled(rows: DataFrame) -> DataFrame:
    """The same rows, each column computed once however often it is used later."""
    return computed_once(rows, {c: F.col(f"`{c}`") for c in rows.columns})
