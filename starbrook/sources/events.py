"""The event feed: streaming sources, and decoding of message values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbrook.functions.scalars import epoch_millis
from starbrook.schemas import EVENT_SCHEMA, columns

# Columns of a message, as the Kafka source names them.
MESSAGE_SCHEMA = columns(
    key=T.BinaryType(),
    value=T.BinaryType(),
    headers=T.ArrayType(columns(key=T.StringType(), value=T.BinaryType())),
)

_CORRUPT = "_corrupt"
_PARSED = T.StructType([*EVENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])


def kafka_options(
    servers: str,
    topic: str,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    sasl_jaas_config: str | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of the Kafka source: start at the newest message and tolerate expired ones."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.security.protocol": security_protocol,
        "kafka.sasl.mechanism": sasl_mechanism,
        "kafka.sasl.jaas.config": sasl_jaas_config,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "includeHeaders": "true",
        **more,
    }
    return {name: value for name, value in options.items() if value is not None}


def event_source(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """A stream of messages from a topic (``kafka``) or from files with the same columns."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load()
    if fmt != "text":
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.load(path)


def parse_events(messages: DataFrame) -> DataFrame:
    """Decodes ``value`` into event columns, with a ``reject_reason`` where that is not possible.

    A message with some unreadable fields keeps the others, and the unreadable ones are null.
    ``raw_value`` is kept for rejected messages only.
    """
    text = F.col("value").cast("string")
    decoded = messages.select(
        text.alias("raw"),
        F.from_json(text, _PARSED, {"columnNameOfCorruptRecord": _CORRUPT}).alias("data"),
    )
    fields = [F.col(f"data.{name}") for name in EVENT_SCHEMA.fieldNames()]
    nothing = reduce(lambda a, b: a & b, (f.isNull() for f in fields))
    time = F.col("data.time_stamp")
    reason = (
        F.when(F.col("raw").isNull(), F.lit("null_value"))
        .when(nothing & F.col(f"data.{_CORRUPT}").isNotNull(), F.lit("malformed_json"))
        .when(nothing, F.lit("empty_event"))
        .when(time.isNotNull() & epoch_millis(time).isNull(), F.lit("time_out_of_range"))
    )
    return decoded.select("*", reason.alias("reject_reason")).select(
        *(F.col(f"data.{name}") for name in EVENT_SCHEMA.fieldNames()),
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("raw")).alias("raw_value"),
    )


def to_messages(events: DataFrame) -> DataFrame:
    """The opposite of ``parse_events``: events as messages keyed by event id."""
    return events.select(
        F.col("id").cast("binary").alias("key"),
        F.to_json(F.struct(*EVENT_SCHEMA.fieldNames())).cast("binary").alias("value"),
        F.array(
            F.struct(F.lit("source").alias("key"), F.lit("web").cast("binary").alias("value"))
        ).alias("headers"),
    )
