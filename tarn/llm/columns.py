"""Columns that only pass through an operator, kept apart from its helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _shelf(i: int) -> str:
    return f"_kept_{i}"


def sheltered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named by position, so that no name of theirs can
    meet the name of a helper column."""
    return docs.toDF(*[_shelf(i) for i in range(len(docs.columns))])


def place(docs: DataFrame, name: str) -> str:
    """What ``sheltered(docs)`` calls a column of ``docs``."""
    return _shelf(docs.columns.index(name))


def restored(made: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    """The columns of ``docs`` by their own names, then those that were added."""
    return made.select(*[F.col(_shelf(i)).alias(c) for i, c in enumerate(docs.columns)], *added)
