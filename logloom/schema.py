"""Field lists and table schemas."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from logloom.shared import list_folders

# The fields of a record and how each is typed.
LONG_FIELDS = ("request_length", "connection_requests", "bytes_sent", "connection")
DOUBLE_FIELDS = ("request_time", "gzip_ratio")
TEXT_LIST_FIELDS = ("forwarded_for", "upstream_addr", "upstream_status")
DOUBLE_LIST_FIELDS = ("upstream_response_time", "upstream_connect_time")
LONG_LIST_FIELDS = ("upstream_response_length",)
TEXT_FIELDS = (
    "request_id",
    "remote_addr",
    "host",
    "upstream_cache_status",
    "request",
    "request_uri",
    "server_protocol",
    "request_path",
    "request_qs",
    "request_path_1",
    "request_path_2",
)

# Everything the line decoder reads by name; other keys go to ``extra``.
DECODED_FIELDS = (
    ("timestamp", "@hostname", "status")
    + TEXT_FIELDS
    + LONG_FIELDS
    + DOUBLE_FIELDS
    + TEXT_LIST_FIELDS
    + DOUBLE_LIST_FIELDS
    + LONG_LIST_FIELDS
)

# Added after parsing, by the geographic lookup.
ENRICHED_FIELDS = ("geoip", "city", "region_name")

POINT = T.StructType(
    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
)
SEGMENT = T.StructType(
    [T.StructField("n", T.IntegerType()), T.StructField("seg", T.StringType())]
)


def _fields(names, kind):
    return [T.StructField(name, kind) for name in names]


RECORD_SCHEMA = T.StructType(
    [
        T.StructField("@timestamp", T.TimestampType()),
        T.StructField("ts_local", T.TimestampNTZType()),
        T.StructField("@hostname", T.StringType()),
    ]
    + _fields(TEXT_FIELDS, T.StringType())
    + [
        T.StructField("status", T.IntegerType()),
        T.StructField("path_segments", T.ArrayType(SEGMENT)),
        T.StructField("query", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("query_geo", POINT),
    ]
    + _fields(LONG_FIELDS, T.LongType())
    + _fields(DOUBLE_FIELDS, T.DoubleType())
    + _fields(TEXT_LIST_FIELDS, T.ArrayType(T.StringType()))
    + _fields(DOUBLE_LIST_FIELDS, T.ArrayType(T.DoubleType()))
    + _fields(LONG_LIST_FIELDS, T.ArrayType(T.LongType()))
    + [
        T.StructField("geoip", POINT),
        T.StructField("city", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("extra", T.MapType(T.StringType(), T.VariantType())),
    ]
)

# Where a line came from; compared as a whole, a later line is greater.
SEQUENCE = T.StructType(
    [
        T.StructField("file_time", T.TimestampType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("line", T.LongType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("_id", T.StringType())]
    + [f for f in RECORD_SCHEMA.fields if f.name != "request_id"]
    + [
        T.StructField("_seq", SEQUENCE),
        T.StructField("_index", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

STATS_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("agg", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("request_path_1", T.StringType()),
        T.StructField("request_path_2", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("upstream_cache_status", T.StringType()),
        T.StructField("bin", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("whole", T.LongType()),
    ]
)


def load_schema(text: str) -> T.StructType:
    """A user's table schema from its JSON form (``StructType.json()``)."""
    return T.StructType.fromJson(json.loads(text))


def merged_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """The columns of both; a column of two types is an error."""
    types = {f.name: f.dataType for f in first.fields}
    for field in second.fields:
        if types.setdefault(field.name, field.dataType) != field.dataType:
            kinds = f"{types[field.name].simpleString()} and {field.dataType.simpleString()}"
            raise ValueError(f"column {field.name!r} can't be {kinds}")
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns ever written to a document table; None for a table without notes."""
    try:
        notes = spark.read.schema("value string").text(f"{path.rstrip('/')}/_schema/*").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    schema = None
    for text in sorted(row.value for row in notes):
        found = load_schema(text)
        schema = merged_schema(schema, found) if schema else found
    return schema


def keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Note the columns of a batch with its table.

    Each different schema is a note of its own, so writers don't disturb each
    other. A batch in which a column has another type than before is refused.
    """
    # What may be null differs from plan to plan.
    text = re.sub(r'"(nullable|containsNull|valueContainsNull)":false', r'"\1":true', schema.json())
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in load_schema(text).fields])
    text = plain.json()
    note = f"{path.rstrip('/')}/_schema/{hashlib.sha256(text.encode()).hexdigest()[:16]}"
    if list_folders(spark, note):
        return
    before = kept_schema(spark, path)
    if before:
        merged_schema(before, plain)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("ignore").text(note)


def ensure_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType = DOCUMENT_SCHEMA,
    force: bool = False,
) -> DataFrame:
    """Declare the document table if it is absent, or again if ``force``.

    The table is external: declaring it again replaces the schema and leaves
    the data files alone. A schema of one's own needs the columns ``_index`` and
    ``batch``, the folders that ``append_documents`` writes.
    """
    if force:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        folders = ", ".join(c for c in ("_index", "batch") if c in schema.fieldNames())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({folders}) LOCATION '{location}'"
        )
    return spark.table(name)


def refresh_table(spark: SparkSession, name: str) -> DataFrame:
    """Make the folders written since the declaration known to the table."""
    spark.catalog.recoverPartitions(name)
    return spark.table(name)
