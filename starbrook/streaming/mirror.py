"""Copies a feed to another sink, at least once, with keys and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starbrook.streaming.delivery import observed

MESSAGE = ["key", "value", "headers"]


def start_mirror(
    source: DataFrame,
    fmt: str,
    checkpoint: str,
    path: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Offsets are committed to the checkpoint only after the sink has taken the batch, so nothing
    is dropped; a failed delivery fails the batch, which is then repeated. Rows and bytes are counted
    on the way; ``delivery.DeliveryLog`` keeps the counts."""
    columns = [c for c in MESSAGE if c in source.columns]
    writer = (
        observed(source.select(*columns))
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
    )
    return writer.start(path) if path else writer.start()

