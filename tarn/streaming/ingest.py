"""Validated ingest as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarn.operators.validate import parse_docs
from tarn.sources.lake import lake_rows


def stream_ingest(
    docs: DataFrame,
    schema: T.DataType | str,
    out: str,
    checkpoint: str,
    keep: list[str] = (),
    once: bool = False,
    **trigger,
) -> StreamingQuery:
    """Validate a stream of documents (a ``raw`` text column) and write both
    outcomes to one lake table, split by ``valid``. The file sink commits each
    batch once, so a restart adds nothing twice. ``once`` takes what is
    there and stops; otherwise ``trigger`` is passed on."""
    rows = lake_rows(parse_docs(docs), schema, keep)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("valid")
        .outputMode("append")
    )
    timing = {"availableNow": True} if once else trigger
    return (writer.trigger(**timing) if timing else writer).start()
