"""Topic and landed-file readers (A1-A3, A8) and message decoding (B1, B2).

A "message source" is either a Kafka topic or a folder of files that hold
rows with the Kafka source's columns (the Kafka connector jar is optional:
the same functions read either).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions import variant as V
from tollgate.operators.contracts import USER_COLUMNS

# Columns of Spark's Kafka source.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# The stream message schema: the user contract's fields, all strings.  ``from_json``
# makes every field nullable whatever is declared, so "not null" is a contract rule instead.
USER_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in USER_COLUMNS])
CORRUPT = "_corrupt_record"

# Landed HTTP responses (A3): one row per fetch.
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("fetch_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("status", T.IntegerType()),  # null: no response, see ``failure``
        T.StructField("failure", T.StringType()),
        T.StructField("retry_after", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class MessageSource:
    """``format='kafka'`` with ``servers`` and ``topic``, or a file format
    (parquet/json/...) with ``path`` holding Kafka-shaped rows."""

    topic: str
    format: str = "parquet"
    path: str | None = None
    servers: str | None = None
    options: dict = field(default_factory=dict)
    max_per_trigger: int | None = None


def message_text(value: str = "value") -> Column:
    """Kafka ``value`` bytes as UTF-8 text (``CAST(value AS STRING)``)."""
    return F.col(value).cast("string")


def read_message_stream(spark: SparkSession, source: MessageSource) -> DataFrame:
    """A1: subscribe one topic from the earliest offset (streaming DataFrame)."""
    if source.format == "kafka":
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source.servers)
            .option("subscribe", source.topic)
            .option("startingOffsets", "earliest")
        )
        if source.max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", source.max_per_trigger)
    else:
        r = spark.readStream.format(source.format).schema(KAFKA_SCHEMA)
        if source.max_per_trigger:
            r = r.option("maxFilesPerTrigger", source.max_per_trigger)
    for k, v in source.options.items():
        r = r.option(k, v)
    return r.load() if source.format == "kafka" else r.load(source.path)


def read_message_batch(spark: SparkSession, source: MessageSource, max_rows: int | None = None) -> DataFrame:
    """A2: bounded read of a topic; with ``max_rows`` the first rows in
    (partition, offset) order (a top-k, not a full sort)."""
    if source.format == "kafka":
        r = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", source.servers)
            .option("subscribe", source.topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
        )
        for k, v in source.options.items():
            r = r.option(k, v)
        df = r.load()
    else:
        df = spark.read.format(source.format).schema(KAFKA_SCHEMA).options(**source.options).load(source.path)
    return first_rows(df, max_rows)


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows by (partition, offset); all rows when ``n`` is None."""
    return df if n is None else df.orderBy("partition", "offset").limit(int(n))


# Landed JSON keeps microseconds (the JSON default would cut to milliseconds).
LANDED_JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_landed_responses(spark: SparkSession, path: str, format: str = "json", stream: bool = False,
                          max_files: int | None = None) -> DataFrame:
    """A3: raw HTTP responses already landed as rows (status, retry_after, body).

    ``max_files`` bounds what a stream takes in at once."""
    r = spark.readStream if stream else spark.read
    if stream and max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if format == "json":
        r = r.options(**LANDED_JSON_OPTIONS)
    return r.format(format).schema(LANDED_SCHEMA).load(path)


def decode_messages(df: DataFrame, schema: T.StructType = USER_SCHEMA, keep: tuple[str, ...] = ()) -> DataFrame:
    """B1: value bytes -> text -> JSON -> one column per schema field.

    ``from_json`` in PERMISSIVE mode with a corrupt-record column, so bad
    text becomes a row (``_corrupt_record`` set) instead of a failure.
    ``keep`` carries source columns (e.g. partition, offset) along.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(message_text(), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # decoded once per row even when callers filter on the decoded fields
    return V.computed_once(df.select(*dict.fromkeys((*keep, "value"))), data, "data").select(
        *keep, *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields],
        F.col(f"data.{CORRUPT}").alias(CORRUPT), F.col("data").isNull().alias("_no_data"),
    )


def malformed_condition(id_col: str = "id") -> Column:
    """B2: rows ``decode_messages`` could not decode, or without an id."""
    return F.col(CORRUPT).isNotNull() | F.col("_no_data") | F.col(id_col).isNull()


def malformed_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(malformed_condition())


def wellformed_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(~malformed_condition()).drop(CORRUPT, "_no_data")


def read_dead_letters(df: DataFrame) -> DataFrame:
    """Decode dead-letter rows with the reader's defaults.

    Both spellings are accepted (R3): ``error``/``error_message``,
    ``topic``/``source_topic``; the original message may be an object or
    JSON text.  Defaults: message ``{}``, error "Unknown error", type
    "Unknown", timestamp "", topic "", retry count 0.  ``readable`` is false
    for a value that is not a JSON object or whose retry count is not a
    number; such rows keep their position but carry no fields.
    """
    staged = V.with_parsed(df.select("partition", "offset", message_text().alias("_text")), "_text", "_v")

    def txt(*keys):
        return V.py_text(V.get(F.col("_v"), *keys))

    rc = V.get(F.col("_v"), "retry_count")
    rc_ok = rc.isNull() | V.is_number(rc)
    readable = V.is_json_object_text(F.col("_text"), F.col("_v")) & rc_ok
    # a number beyond 64 bits counts as the largest, so that it is over any limit
    huge = F.when(F.try_variant_get(rc, "$", "double") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(0))
    om = V.get(F.col("_v"), "original_message")
    om_text = F.when(V.vtype(om) == "STRING", F.try_variant_get(om, "$", "string")).otherwise(F.to_json(om))
    out = staged.select(
        "partition",
        "offset",
        readable.alias("readable"),
        F.when(readable, F.coalesce(om_text, F.lit("{}"))).alias("original_message"),
        F.when(readable, F.coalesce(txt("error"), txt("error_message"), F.lit("Unknown error"))).alias("error_message"),
        F.when(readable, F.coalesce(txt("error_type"), F.lit("Unknown"))).alias("error_type"),
        F.when(readable, F.coalesce(txt("timestamp"), F.lit(""))).alias("timestamp"),
        F.when(readable, F.coalesce(txt("topic"), txt("source_topic"), F.lit(""))).alias("topic"),
        F.when(readable, F.coalesce(F.try_variant_get(rc, "$", "bigint"), huge)).alias("retry_count"),
    )
    return out
