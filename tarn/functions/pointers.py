"""JSON pointers (RFC 6901) as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.plans.schema import ANY_INDEX

# What RFC 6901 does not accept in a pointer, and what it accepts as an
# array index in one. Neither repeats a group: Java would recurse on a long path.
BAD_ESCAPE = r"~([^01]|\z)"
INDEX_STEP = r"/(0|[1-9][0-9]*)(?=/|\z)"


def is_pointer(path: Column) -> Column:
    return (path == "") | (path.startswith("/") & ~path.rlike(BAD_ESCAPE))


def any_index(path: Column) -> Column:
    """The path with each number step turned into the any-index step."""
    return F.regexp_replace(path, INDEX_STEP, f"/{ANY_INDEX}")


def steps(path: Column) -> Column:
    """The steps of a pointer, still escaped; none for the root."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.slice(F.split(path, "/"), 2, 2**30))
