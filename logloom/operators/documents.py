"""Documents: keyed, routed by date, written so that repeats do no harm."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterable
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.time import as_instant, iso_text, strftime
from logloom.schema import DOCUMENT_SCHEMA, ENRICHED_FIELDS, keep_schema, kept_schema
from logloom.shared import delete_folder, list_folders

# Fixed value: the default date pattern that routes a document.
DEFAULT_PATTERN = "nginx-%Y.%m.%d"
DEFAULT_TYPE = "access_log"

#: Columns that steer a document and are no part of its body as such.
CONTROL = ("_id", "_index", "_seq", "batch")
#: Where dead letters lie that are written together with documents, and what they consist of.
REJECTED = "_rejected"
LETTER = ("_line", "_errors")
#: Begins the names of batches that compaction has written.
COMPACTED = "compacted-"
# Fixed value: the folder name of a partition value that is NULL.
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: Most dates that a read names one by one; longer ranges are cut by a filter.
MOST_NAMES = 1000


def route_index(records: DataFrame, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """Add ``_index``, the record's own local date in ``pattern``."""
    return records.withColumn("_index", strftime("ts_local", pattern))


def index_range(
    pattern: str, min_timestamp=None, max_timestamp=None
) -> tuple[str | None, str | None]:
    """Bounds of ``_index`` that hold every document of a time range.

    A record's local date, and the session's reading of a bound without an
    offset, are each less than a day off, so two days are added on both sides.
    Only patterns that sort like time can be bounded; others give None.
    """
    directives = re.findall(r"%(.)", pattern)[:3]
    if directives not in (["Y", "m", "d"], ["Y", "m"], ["Y"]):
        return None, None

    def bound(value, days: int) -> str | None:
        try:
            at = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
        except ValueError:
            return None
        if not isinstance(at, dt.datetime):
            return None
        return (at + dt.timedelta(days=days)).strftime(pattern)

    return bound(min_timestamp, -2), bound(max_timestamp, 2)


def to_documents(records: DataFrame, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """Documents of the records that have a key.

    ``request_id`` becomes ``_id``; everything else stays a column. Records
    without a key are listed by ``rejected`` when it is asked to require one.
    """
    return (
        route_index(records, pattern)
        .where(F.col("request_id").isNotNull())
        .withColumnRenamed("request_id", "_id")
    )


def to_documents_and_letters(
    records: DataFrame, pattern: str = DEFAULT_PATTERN, min_timestamp=None, max_timestamp=None
) -> DataFrame:
    """Documents of the records of ``parse_access_log`` and letters of the bad ones, in one plan.

    Letters have the ``_index`` of ``REJECTED``, their text and the unreadable fields,
    which a document has not. A record without a key is a letter. The time
    range is tested on documents only.
    """
    good = "(_good AND request_id IS NOT NULL)"
    routed = route_index(records, pattern)
    if min_timestamp is not None:
        routed = routed.where(F.expr(f"NOT {good}") | (F.col("`@timestamp`") >= as_instant(min_timestamp)))
    if max_timestamp is not None:
        routed = routed.where(F.expr(f"NOT {good}") | (F.col("`@timestamp`") < as_instant(max_timestamp)))
    body = [f"IF({good}, `{c}`, NULL) AS `{c}`" for c in routed.columns if c not in ("_index", "_good", "request_id", *LETTER)]
    return routed.selectExpr(
        f"IF({good}, request_id, NULL) AS _id", *body, f"IF({good}, _index, '{REJECTED}') AS _index",
        f"IF({good}, NULL, _line) AS _line",
        f"CASE WHEN NOT _good THEN _errors WHEN request_id IS NULL THEN array('request_id') END AS _errors",
    )


def source_json(documents: DataFrame) -> Column:
    """The document body as one flat JSON object.

    Path components become ``request_path_<n>`` and unknown fields keep their
    JSON type, unless an extension has set a column of that name. Absent fields
    are left out.
    """
    present = set(documents.columns)
    apart = {*CONTROL, "@timestamp", "ts_local", "path_segments", "extra", "request_path_1", "request_path_2"}
    ours = [f.name for f in DOCUMENT_SCHEMA.fields if f.name in present and f.name not in apart]
    # What extensions have added comes after the fields of every document.
    added = [c for c in documents.columns if c not in apart and c not in DOCUMENT_SCHEMA.fieldNames()]
    named = ours + added
    known = F.struct(
        F.expr(iso_text("ts_local", "`@timestamp`")).alias("@timestamp"),
        *[F.col(f"`{c}`") for c in named],
    )
    # Components 1 and 2 can also come from the line itself, without a path.
    first = F.map_filter(
        F.create_map(
            F.lit("request_path_1"), F.col("request_path_1"),
            F.lit("request_path_2"), F.col("request_path_2"),
        ),
        lambda k, v: v.isNotNull(),
    )
    rest = F.map_from_entries(
        F.transform(
            F.filter(
                F.coalesce(
                    "path_segments", F.array().cast("array<struct<n:int,seg:string>>")
                ),
                lambda s: ~s["n"].isin(1, 2),
            ),
            lambda s: F.struct(
                F.concat(F.lit("request_path_"), s["n"].cast("string")), s["seg"]
            ),
        )
    )
    paths = F.map_concat(first, rest)
    overridden = F.array(
        *[
            F.when(F.col(f"`{c}`").isNotNull(), F.lit(c))
            for c in ("query", "query_geo", *ENRICHED_FIELDS, *added)
            if c in present
        ]
    )
    # Inside a lambda these would be evaluated per key; few documents have a key to leave out.
    taken = F.concat(overridden, F.map_keys(paths))
    others = F.transform(
        F.array(taken),
        lambda t: F.map_filter(F.col("extra"), lambda k, _: ~F.coalesce(F.array_contains(t, k), F.lit(False))),
    )
    clash = F.coalesce(F.arrays_overlap(F.map_keys("extra"), taken), F.lit(False))
    extra = F.when(clash, F.get(others, F.lit(0))).otherwise(F.col("extra"))
    members = [
        F.nullif(_members(F.to_json(part)), F.lit("")) for part in (known, paths, extra)
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _members(json: Column) -> Column:
    """The text between the braces of a JSON object, cut by bytes."""
    return F.substring(json.cast("binary"), F.lit(2), F.octet_length(json) - 2).cast("string")


def to_envelope(documents: DataFrame, doc_type: str = DEFAULT_TYPE) -> DataFrame:
    """``_id``, ``_index``, ``_type`` and the body as the struct ``_source``."""
    body = [F.col(f"`{c}`") for c in documents.columns if c not in CONTROL]
    return documents.select(
        "_id", "_index", F.lit(doc_type).alias("_type"), F.struct(*body).alias("_source")
    )


def json_lines(documents: DataFrame, doc_type: str = DEFAULT_TYPE) -> DataFrame:
    """One JSON line ``{_id, _index, _type, _source}`` per document."""
    head = F.to_json(F.struct("_id", "_index", F.lit(doc_type).alias("_type")))
    return documents.select(
        F.concat(
            F.lit("{"),
            _members(head),
            F.lit(',"_source":'),
            source_json(documents),
            F.lit("}"),
        ).alias("value")
    )


def latest_documents(documents: DataFrame, sequence: str = "_seq") -> DataFrame:
    """One document per ``_index`` and ``_id``: the one that came last.

    A document is written once per delivery; this is what readers see. Each
    task keeps the last of its copies before the shuffle, so a key that holds a
    large share of all rows sends one row per task, and columns that the query
    doesn't use are not read.
    """
    newest = Window.partitionBy("_index", "_id").orderBy(F.col(sequence).desc_nulls_last())
    return documents.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def append_documents(documents: DataFrame, path: str, batch: str, stale: bool = True) -> None:
    """Write a batch of documents, by ``_index`` and within it by ``batch``.

    A replay after a failure replaces what the batch wrote before, and with
    ``stale`` it is also removed from dates that it no longer has (a stream's replays
    have the same rows, so streams save that look). Rows are first brought
    together by date, so that a task doesn't write a file for every date; a date
    that is too large for one task is split. Copies between and within batches
    are settled by ``read_documents``. The columns are noted with the table.
    """
    spark = documents.sparkSession
    keep_schema(spark, path, table_schema(documents))
    before = _folders(spark, path, None, batch) if stale else []
    (
        documents.drop("batch").withColumn("batch", F.lit(batch)).hint("rebalance", "_index")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_index", "batch").parquet(path)
    )
    if before:
        # Only a batch that runs again looks for the dates it has now.
        dates = documents.select(F.expr(f"coalesce(_index, '{_NO_DATE}') AS date")).distinct().collect()
        kept = {f"_index={r.date}" for r in dates}
        for folder in before:
            if unquote(folder.split("/")[-2]) not in kept:
                delete_folder(spark, folder)


def _folders(spark: SparkSession, path: str, dates: Iterable[str] | None, batch: str | None = None) -> list[str]:
    """Folders of a table's dates (None: all), or of one batch in them."""
    names = "*" if dates is None else ",".join(_folder_name(spark, d) for d in sorted(set(dates)))
    if not names:
        return []
    pattern = f"{path.rstrip('/')}/_index={{{names}}}" if "," in names else f"{path.rstrip('/')}/_index={names}"
    if batch is not None:
        pattern += f"/batch={batch if batch == '*' else _folder_name(spark, batch)}"
    return list_folders(spark, pattern)


def _folder_name(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder name, for use in a glob pattern."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return re.sub(r"([*?\[\]{}\\,])", r"\\\1", escaped)


def table_schema(documents: DataFrame | T.StructType = DOCUMENT_SCHEMA) -> T.StructType:
    """Schema of a document table: partition columns last, as text."""
    schema = documents if isinstance(documents, T.StructType) else documents.schema
    body = [f for f in schema.fields if f.name not in ("_index", "batch", *LETTER)]
    return T.StructType(
        body + [T.StructField("_index", T.StringType()), T.StructField("batch", T.StringType())]
    )


def _index_names(pattern: str, low: str | None, high: str | None) -> list[str] | None:
    """Every ``_index`` of the days between two bounds; None if they can't be listed or are too many."""
    daily = set(re.findall(r"%(.)", pattern)) <= set("Yymdj%")
    if low is None or high is None or not daily:
        return None
    first, last = (dt.datetime.strptime(bound, pattern) for bound in (low, high))
    if (last - first).days >= MOST_NAMES:
        return None
    days = range((last - first).days + 1)
    return sorted({(first + dt.timedelta(days=n)).strftime(pattern) for n in days})


def read_versions(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    pattern: str = DEFAULT_PATTERN,
    min_timestamp=None,
    max_timestamp=None,
    index: str | Iterable[str] | None = None,
) -> DataFrame:
    """Every version written to ``path``, in the partitions of a time range.

    ``index`` names the dates instead. Of a table read by both bounds, or by
    names, only the folders of those dates are listed. The columns are those
    noted with the table, or those of ``schema``.
    """
    schema = table_schema(schema or kept_schema(spark, path) or DOCUMENT_SCHEMA)
    low, high = index_range(pattern, min_timestamp, max_timestamp)
    names = [index] if isinstance(index, str) else index
    if names is None:
        names = _index_names(pattern, low, high)
    places = [path] if names is None else _folders(spark, path, names)
    versions = spark.createDataFrame([], schema)
    if places:
        try:
            versions = spark.read.schema(schema).option("basePath", path).parquet(*places)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    tests = [F.expr(f"_index IS NULL OR _index <> '{REJECTED}'")]
    tests += [F.col("_index") >= low] if low else []
    tests += [F.col("_index") <= high] if high else []
    return versions.where(reduce(and_, tests))


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    """Text, unreadable fields and batch of the dead letters that lie with the documents of a table."""
    schema = "_line string, _errors array<string>, batch string"
    places = _folders(spark, path, [REJECTED])
    letters = spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)
    return letters.select(F.col("_line").alias("value"), F.col("_errors").alias("errors"), "batch")


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    pattern: str = DEFAULT_PATTERN,
    min_timestamp=None,
    max_timestamp=None,
    index: str | Iterable[str] | None = None,
) -> DataFrame:
    """The current documents of a table."""
    versions = read_versions(spark, path, schema, pattern, min_timestamp, max_timestamp, index)
    return latest_documents(versions).drop("batch")


def stream_versions(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """Every version that is written to ``path``, as a stream of typed records.

    Statistics can follow the table this way, and lines are decoded once for both.
    What compaction writes has been seen before and is left out. Records without a
    key are not in the table.
    """
    schema = table_schema(schema or kept_schema(spark, path) or DOCUMENT_SCHEMA)
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).where(f"_index <> '{REJECTED}' AND NOT startswith(batch, '{COMPACTED}')")


def upsert_documents(
    spark: SparkSession, incoming: DataFrame, path: str, batch: str
) -> DataFrame:
    """Add a batch to a table and return the table's current documents."""
    append_documents(incoming, path, batch)
    return read_documents(spark, path)


def compact_documents(
    spark: SparkSession, path: str, target: str, schema: T.StructType | None = None
) -> None:
    """Write the current documents of ``path`` as one batch of a new table.

    The old table stays as it is, so a failure midway loses nothing. A
    ``schema`` that lacks a column of the table is refused.
    """
    kept = kept_schema(spark, path)
    lost = {f.name for f in kept or ()} - {f.name for f in schema or kept or ()} - {"_index", "batch"}
    if lost:
        raise ValueError(f"compaction would drop {', '.join(sorted(lost))}")
    append_documents(read_documents(spark, path, schema), target, "settled")


def dates_to_compact(spark: SparkSession, path: str, least: int = 2) -> list[str]:
    """Dates (``_index``) that at least ``least`` batches have written to."""
    found: dict[str, int] = {}
    for folder in _folders(spark, path, None, "*"):
        date = unquote(folder.split("/")[-2].removeprefix("_index="))
        found[date] = found.get(date, 0) + 1
    return sorted(date for date, n in found.items() if n >= least and date != REJECTED)


def compact_dates(spark: SparkSession, path: str, dates: Iterable[str], keep_sources: bool = False) -> list[str]:
    """Settle dates of a table in place, beside writers that go on.

    The batches that the dates have at the start are read, their current documents
    are written as one new batch per date, and then the old folders are deleted. At every moment
    the table holds each current document at least once, and readers settle
    repeats, so a failure midway or a replayed batch changes nothing. A reader that
    listed the old folders before fails when they go: with ``keep_sources`` they stay,
    and the caller removes the returned folders later with ``delete_folder``.
    """
    sources = sorted(_folders(spark, path, dates, "*"))
    if not sources:
        return []
    name = COMPACTED + hashlib.sha256("\n".join(sources).encode()).hexdigest()[:16]
    schema = table_schema(kept_schema(spark, path) or DOCUMENT_SCHEMA)
    versions = spark.read.schema(schema).option("basePath", path).parquet(*sources)
    append_documents(latest_documents(versions), path, name, stale=False)
    if not keep_sources:
        for folder in sources:
            delete_folder(spark, folder)
    return sources
