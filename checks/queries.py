"""Every operator as a query over the given tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.lines import access_log_from_events, events_for_all_cores, spread, table
from logloom.functions.time import bucket_start, parse_timestamp
from logloom.functions.traffic import cache_label, last_value, latency_bin, path_label
from logloom.functions.uri import path_segments, query_map, uri_path, uri_query
from logloom.operators.documents import (
    append_documents,
    compact_dates,
    dates_to_compact,
    json_lines,
    latest_documents,
    read_documents,
    read_letters,
    read_versions,
    route_index,
    stream_versions,
    to_documents,
    to_envelope,
)
from logloom.operators.extensions import apply_extensions, pandas_extension
from logloom.operators.filters import time_range
from logloom.operators.geo import geoip_join
from logloom.operators.parse import accepted, parse_access_log, rejected
from logloom.operators.stats import http_stats, metric_lines, traffic_rows
from logloom.plans.jobs import index_log
from logloom.schema import LONG_FIELDS, ensure_table, load_schema, refresh_table
from logloom.shared import shared_folder
from logloom.sinks import read_metrics
from logloom.sources.access_log import read_access_log, stream_access_log
from logloom.sources.growing import follow_access_log
from logloom.streaming.queries import flush_stats, late_records, stream_stats, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

HOSTNAME = "web1"
PREFIX = "traffic.web1"
MONTH = 2_592_000
RANGE = ("2024-01-05T00:00:00+00:00", "2024-01-20T12:00:00+00:00")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log_from_events(events_for_all_cores(spark, sf_dir))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(lines(spark, sf_dir), hostname=HOSTNAME)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parsed(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_documents(records(spark, sf_dir)).withColumn("_seq", F.col("event_id"))


def millis(seconds: Column) -> Column:
    """Text with three decimals, so that sums compare alike in any order."""
    return F.when(seconds.isNotNull(), F.format_string("%.3f", seconds))


# --- record projection -----------------------------------------------------


def parse_core(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id",
        F.unix_seconds("`@timestamp`").alias("epoch"),
        F.col("ts_local").cast("string").alias("wall_clock"),
        F.col("`@hostname`").alias("hostname"),
        "request_id",
        F.col("status").cast("bigint").alias("status"),
        *LONG_FIELDS,
        millis(F.col("request_time")).alias("request_time"),
        millis(F.col("gzip_ratio")).alias("gzip_ratio"),
    )


def dash_prune(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id",
        "host",
        "upstream_cache_status",
        F.try_variant_get("extra.http_user_agent", "$", "string").alias("http_user_agent"),
        F.col("connection_requests").isNull().alias("no_connection_requests"),
    )


def quarantine(spark, sf_dir):
    letters = rejected(parsed(spark, sf_dir), required=("request_id",))
    return letters.select("event_id", "value", F.array_join("errors", ",").alias("errors"))


def request_split(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id", "request", "request_uri", "server_protocol"
    )


def uri_split(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", f"{uri_path('url')} AS path", f"{uri_query('url')} AS qs"
    )


def log_uri(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id", "request_path", "request_qs", "request_path_1", "request_path_2"
    )


def query_multimap(spark, sf_dir):
    """Query strings of page addresses and of the log, one row per value."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("source"),
        F.expr(uri_query("url")).alias("qs"),
    )
    log = records(spark, sf_dir).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("source"),
        F.col("request_qs").alias("qs"),
    )
    entries = pages.unionByName(log).select(
        "source", F.expr(f"explode({query_map('qs')}) AS (key, values)")
    )
    return entries.select("source", "key", F.posexplode("values").alias("pos", "value")).select(
        "source", "key", F.col("pos").cast("bigint").alias("pos"), "value"
    )


def query_key_rename(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id", F.explode("query").alias("key", "values")
    ).select("event_id", "key", F.array_join("values", "|").alias("joined"))


def query_geo(spark, sf_dir):
    return records(spark, sf_dir).where("query is not null").select(
        "event_id",
        F.col("query_geo.lat").alias("lat"),
        F.col("query_geo.lon").alias("lon"),
    )


def path_parts(spark, sf_dir):
    """Numbered components of page addresses and of the log."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("source"),
        F.expr(f"{path_segments(uri_path('url'))} AS segments"),
    )
    log = records(spark, sf_dir).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("source"),
        F.col("path_segments").alias("segments"),
    )
    return pages.unionByName(log).select("source", F.inline("segments")).select(
        "source", F.col("n").cast("bigint").alias("n"), "seg"
    )


def upstream_lists(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id",
        F.array_join("forwarded_for", "|").alias("forwarded_for"),
        F.array_join("upstream_addr", "|").alias("upstream_addr"),
        F.array_join("upstream_status", "|").alias("upstream_status"),
    )


def upstream_numeric(spark, sf_dir):
    def joined(name: str) -> Column:
        return F.array_join(F.transform(name, millis), "|").alias(name)

    return records(spark, sf_dir).select(
        "event_id",
        joined("upstream_response_time"),
        joined("upstream_connect_time"),
        F.array_join(
            F.col("upstream_response_length").cast("array<string>"), "|"
        ).alias("upstream_response_length"),
    )


def extra_fields(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id", F.explode("extra").alias("key", "field")
    ).select("event_id", "key", F.to_json("field").alias("value"))


def timestamp_formats(spark, sf_dir):
    """The same instant from an ISO text and from the common log format."""
    stamped = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss").alias("local"),
        F.when(F.col("user_id") % 2 == 0, "+0300").otherwise("-0500").alias("zone"),
    )
    instant, wall = parse_timestamp("concat_ws(' ', local, zone)", ["dd/MMM/yyyy:HH:mm:ss Z"])
    return stamped.selectExpr(
        "event_id", f"unix_seconds({instant}) AS epoch", f"CAST({wall} AS STRING) AS wall_clock"
    )


# --- enrichment, filters, extensions ----------------------------------------


def nation_ranges(spark, sf_dir):
    """Address ranges: nation n owns the lower half of 10.n.0.0/16."""
    first = F.lit(10 * 16777216) + F.col("n_nationkey").cast("bigint") * 65536
    return table(spark, sf_dir, "nation").select(
        first.alias("lo"),
        (first + 32767).alias("hi"),
        (F.col("n_nationkey") + 0.5).alias("lat"),
        (F.col("n_nationkey") - 0.5).alias("lon"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("region_name"),
    )


def _places(joined):
    return joined.select(
        "event_id",
        "remote_addr",
        F.col("geoip.lat").alias("lat"),
        F.col("geoip.lon").alias("lon"),
        "city",
        "region_name",
    )


def geo_lookup(spark, sf_dir):
    return _places(geoip_join(records(spark, sf_dir), nation_ranges(spark, sf_dir)))


def geo_lookup_shuffled(spark, sf_dir):
    """The same lookup as if the range table were too large to broadcast."""
    return _places(
        geoip_join(
            records(spark, sf_dir),
            nation_ranges(spark, sf_dir),
            broadcast_bytes=-1,
        )
    )


def _net_ranges(spark, sf_dir):
    """The middle half of every even net that events come from, and a range over many nets."""
    nets = table(spark, sf_dir, "events").where("user_id % 2 = 0").selectExpr("user_id % 4 AS a", "user_id % 256 AS b")
    halves = nets.distinct().selectExpr(
        "(10 * 256 + a) * 65536 + b * 256 + 64 AS lo", "(10 * 256 + a) * 65536 + b * 256 + 191 AS hi",
        "a + 0.5D AS lat", "b + 0.5D AS lon", "concat_ws('.', 'net', a, b) AS city", "'half' AS region_name",
    )
    wide = spark.range(1).selectExpr(
        "CAST((10 * 256 + 3) * 65536 + 65500 AS BIGINT) AS lo", "CAST(200 * 16777216L AS BIGINT) AS hi",
        "0D AS lat", "0D AS lon", "'far' AS city", "'wide' AS region_name",
    )
    return halves.unionByName(wide)


def geo_merge(spark, sf_dir):
    """The lookup that sorts addresses and ranges together, on many small ranges."""
    return _places(geoip_join(records(spark, sf_dir), _net_ranges(spark, sf_dir), broadcast_bytes=-1))


def geo_lookup_absent(spark, sf_dir):
    return _places(geoip_join(records(spark, sf_dir), None))


def in_time_range(spark, sf_dir):
    return time_range(records(spark, sf_dir), *RANGE).select(
        "event_id", F.unix_seconds("`@timestamp`").alias("epoch")
    )


def status_filter(spark, sf_dir):
    """Hits that count, by host and status."""
    return (
        traffic_rows(records(spark, sf_dir))
        .groupBy("host", F.col("status").cast("bigint").alias("status"))
        .agg(F.count("*").alias("hits"))
    )


def _mark_slow(df):
    return df.withColumn("slow", F.coalesce(F.col("request_time") > 0.5, F.lit(False)))


def _errors_only(df):
    return df.where("status >= 500")


def extension_transforms(spark, sf_dir):
    extended = apply_extensions(records(spark, sf_dir), [_mark_slow, _errors_only])
    return extended.select("event_id", "slow", F.col("status").cast("bigint").alias("status"))


def extension_in_python(spark, sf_dir):
    def add_family(batch):
        batch["family"] = batch["upstream_cache_status"].fillna("none").str.lower()
        return batch[["event_id", "family"]]

    narrow = records(spark, sf_dir).select("event_id", "upstream_cache_status")
    step = pandas_extension(add_family, "event_id bigint, family string")
    return apply_extensions(narrow, [step])


# --- documents ---------------------------------------------------------------


def index_route(spark, sf_dir):
    return (
        route_index(records(spark, sf_dir), "log-%Y.%m.%d-%j")
        .groupBy("_index")
        .agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))
    )


def document_envelope(spark, sf_dir):
    enveloped = to_envelope(documents(spark, sf_dir))
    return enveloped.select(
        "_id",
        "_index",
        "_type",
        F.col("_source.event_id").alias("event_id"),
        F.col("_source.host").alias("host"),
        F.col("_source.request_path").alias("request_path"),
    )


_WRITTEN = """
  `_id` string, `_index` string, `_source` struct<
    `@timestamp`:string, `@hostname`:string, request_uri:string, request_path_1:string,
    request_path_4:string, query:struct<a_b:string>, query_geo:struct<lat:string>,
    upstream_addr:string, bytes_sent:string, tcp_rtt:string, tls:string, props:string>
"""


def document_lines(spark, sf_dir):
    """JSON lines as written, read back as text fields."""
    written = json_lines(documents(spark, sf_dir).drop("event_id"))
    return written.select(F.from_json("value", _WRITTEN).alias("d")).selectExpr(
        "d._id AS id",
        "d._index AS idx",
        "d._source.`@timestamp` AS ts",
        "d._source.`@hostname` AS web",
        "d._source.request_uri AS uri",
        "d._source.request_path_1 AS path_1",
        "d._source.request_path_4 AS path_4",
        "d._source.query.a_b AS a_b",
        "d._source.query_geo.lat AS lat",
        "d._source.upstream_addr AS upstreams",
        "d._source.bytes_sent AS bytes",
        "d._source.tcp_rtt AS rtt",
        "d._source.tls AS tls",
        "d._source.props AS props",
    )


def upsert_latest(spark, sf_dir):
    return latest_documents(documents(spark, sf_dir)).select(
        "_index", "_id", "event_id", F.col("status").cast("bigint").alias("status")
    )


def _key_columns(found):
    return found.select("_index", "_id", "event_id", F.col("status").cast("bigint").alias("status"))


def compacted_dates(spark, sf_dir):
    """All versions of a table of three batches after every date is compacted in place."""
    path, versions = f"{shared_folder(spark, 'documents')}/table", documents(spark, sf_dir)
    for part in range(3):
        append_documents(versions.where(F.col("event_id") % 3 == part), path, f"part-{part}")
    compact_dates(spark, path, dates_to_compact(spark, path))
    return _key_columns(read_versions(spark, path))


def declared_table(spark, sf_dir):
    """The documents by way of a table declared with a schema of one's own."""
    path, name = f"{shared_folder(spark, 'documents')}/table", f"documents_{uuid.uuid4().hex}"
    written = documents(spark, sf_dir)
    append_documents(written, path, "all")
    schema = load_schema(read_versions(spark, path).schema.json())
    ensure_table(spark, name, path, schema, force=True)
    return _key_columns(latest_documents(refresh_table(spark, name)))


def index_with_rejects(spark, sf_dir):
    """Documents and dead letters that one job has written together."""
    path = f"{shared_folder(spark, 'documents')}/table"
    text = lines(spark, sf_dir).withColumn("_seq", F.col("event_id"))
    index_log(spark, text, path, "all", rejects=True, hostname=HOSTNAME, min_timestamp=RANGE[0])
    kept = read_versions(spark, path).selectExpr("_index AS place", "_id AS text", "CAST(NULL AS STRING) AS errors")
    letters = read_letters(spark, path).selectExpr("batch AS place", "value AS text", "array_join(errors, ',') AS errors")
    return kept.unionByName(letters)


def extension_documents(spark, sf_dir):
    """What extensions add, through table, settled read and JSON lines; half of the documents have none."""
    path, kept = f"{shared_folder(spark, 'documents')}/table", records(spark, sf_dir)

    def timing(df):
        return df.withColumn("timing", F.struct(F.col("request_time").alias("total"), F.col("status").alias("code")))

    for part, extensions in ((0, [_mark_slow, timing]), (1, [])):
        extended = apply_extensions(kept.where(F.col("event_id") % 2 == part), extensions)
        append_documents(to_documents(extended).withColumn("_seq", F.col("event_id")), path, f"part-{part}")
    compact_dates(spark, path, dates_to_compact(spark, path))
    shape = "_id string, _source struct<event_id:string,slow:string,timing:struct<total:double,code:string>>"
    return json_lines(read_documents(spark, path)).select(F.from_json("value", shape).alias("d")).selectExpr(
        "d._id AS id", "CAST(d._source.event_id AS BIGINT) AS event_id", "d._source.slow AS slow",
        "IF(d._source.timing.total IS NOT NULL, printf('%.3f', d._source.timing.total), NULL) AS total", "d._source.timing.code AS code",
    )


# --- sources -------------------------------------------------------------------


def _as_text(lines, spark, compression="none"):
    """The lines as closed text files."""
    path = f"{shared_folder(spark, 'log')}/lines"
    lines.select("value").write.option("compression", compression).text(path)
    return path


def _requests(found):
    return found.selectExpr(
        "request_id", "unix_seconds(`@timestamp`) AS epoch", "host", "CAST(status AS BIGINT) AS status"
    )


def text_scan(spark, sf_dir):
    """Compressed text files, of which every line counts."""
    path = _as_text(lines(spark, sf_dir), spark, "gzip")
    return _requests(accepted(parse_access_log(read_access_log(spark, path))))


def invalid_bytes(spark, sf_dir):
    """Lines with bytes that are no text."""
    broken = table(spark, sf_dir, "events").select(
        F.expr(
            """concat('{"timestamp":"2024-01-01T00:00:00Z","request_id":"e', event_id, '","host":"h',
            CAST(unhex(CASE event_id % 3 WHEN 0 THEN 'FF' WHEN 1 THEN 'C3' ELSE 'C3A9' END) AS STRING), user_id % 5, '"}')"""
        ).alias("value")
    )
    path = _as_text(broken, spark)
    return accepted(parse_access_log(read_access_log(spark, path))).select("request_id", "host")


def timestamp_parser(spark, sf_dir):
    """Timestamps in a format of one's own: epoch seconds and an offset."""
    seconds = "unix_date(CAST(ts AS DATE)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
    stamped = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"to_json(struct(concat({seconds}, CASE WHEN event_id % 7 = 0 THEN ' ?' WHEN event_id % 2 = 0 THEN ' 2' ELSE ' -3' END)"
        " AS timestamp, concat('r', event_id) AS request_id)) AS value",
    )

    def epochs(raw):
        seconds = F.try_to_number(F.split_part(raw, F.lit(" "), F.lit(1)), F.lit("99999999999")).cast("bigint")
        hours = F.split_part(raw, F.lit(" "), F.lit(2)).try_cast("bigint")
        instant = F.when(hours.isNotNull(), F.timestamp_seconds(seconds))
        wall = F.make_timestamp_ntz(*map(F.lit, (1970, 1, 1, 0, 0, 0))) + F.make_interval(secs=seconds + hours * 3600)
        return instant, F.when(hours.isNotNull(), wall)

    found = accepted(parse_access_log(stamped, ts_parser=epochs))
    return found.selectExpr("event_id", "unix_seconds(`@timestamp`) AS epoch", "CAST(ts_local AS STRING) AS wall_clock")


# --- statistics ----------------------------------------------------------------


def interval_bucket(spark, sf_dir):
    return (
        records(spark, sf_dir)
        .groupBy(F.expr(f"{bucket_start('`@timestamp`', 10)} AS bucket"))
        .agg(F.count("*").alias("n"))
    )


def path_normalise(spark, sf_dir):
    return records(spark, sf_dir).selectExpr(
        "event_id",
        f"{path_label('request_path_1')} AS p1",
        f"{path_label('request_path_2')} AS p2",
        f"{cache_label('upstream_cache_status')} AS cache",
    )


def latency_bins(spark, sf_dir):
    return records(spark, sf_dir).selectExpr(
        "event_id",
        f"{latency_bin('request_time')} AS request_bin",
        f"{latency_bin(last_value('upstream_response_time'))} AS upstream_bin",
    )


def _stats(metric: str | None, interval: int) -> Query:
    def run(spark, sf_dir):
        chosen = {} if metric is None else {"metrics": (metric,)}
        return http_stats(records(spark, sf_dir), interval, **chosen).select(
            "bucket",
            "metric",
            "agg",
            "host",
            "request_path_1",
            "request_path_2",
            F.col("status").cast("bigint").alias("status"),
            "upstream_cache_status",
            "bin",
            millis(F.col("value")).alias("value"),
        )

    return run


def _metric_lines(interval: int) -> Query:
    def run(spark, sf_dir):
        return metric_lines(http_stats(records(spark, sf_dir), interval), PREFIX)

    return run


# --- streaming -----------------------------------------------------------------


def stream_lines(spark, sf_dir):
    """The derived log as a stream: the events file arrives in its folder."""
    schema = table(spark, sf_dir, "events").schema
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    tasks = spread(spark, sf_dir, spark.sparkContext.defaultParallelism)
    return access_log_from_events(arriving.repartition(tasks, "event_id"))


def streamed_stats(spark, sf_dir):
    """Metric lines of the intervals that close while the stream catches up."""
    parsed_stream = accepted(parse_access_log(stream_lines(spark, sf_dir), hostname=HOSTNAME))
    folder = shared_folder(spark, "stream-stats")
    query = stream_stats(
        parsed_stream,
        f"{folder}/metrics",
        f"{folder}/checkpoint",
        PREFIX,
        interval=3600,
        trigger=None,
    )
    query.awaitTermination()
    return spark.read.schema("value string").text(f"{folder}/metrics").select("value")


def streamed_stats_flushed(spark, sf_dir):
    """Metric values of all intervals: closed by the stream, and flushed from its state."""
    parsed_stream = accepted(parse_access_log(stream_lines(spark, sf_dir), hostname=HOSTNAME))
    folder = shared_folder(spark, "stream-stats")
    place = (f"{folder}/metrics", f"{folder}/checkpoint", PREFIX)
    stream_stats(parsed_stream, *place, interval=3600, trigger=None).awaitTermination()
    flush_stats(spark, *place)
    return read_metrics(spark, f"{folder}/metrics").selectExpr("name", "value", "time AS bucket")


def streamed_late(spark, sf_dir):
    """Late records per interval: every tenth event arrives after all others."""
    folder, events = shared_folder(spark, "stream-late"), table(spark, sf_dir, "events")
    for late in (False, True):
        events.where((F.col("event_id") % 10 == 0) == late).write.parquet(f"{folder}/events/late={late}")
        arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events/*")
        parsed_stream = accepted(parse_access_log(access_log_from_events(arriving)))
        query = stream_stats(
            parsed_stream, f"{folder}/metrics", f"{folder}/checkpoint", PREFIX,
            interval=3600, trigger=None, late=f"{folder}/late",
        )
        query.awaitTermination()
    return late_records(spark, f"{folder}/late")


def _streamed(spark, arriving, **options):
    folder = shared_folder(spark, "stream-documents")
    query = stream_upsert(arriving, f"{folder}/documents", f"{folder}/checkpoint", trigger=None, hostname=HOSTNAME, **options)
    query.awaitTermination()
    return f"{folder}/documents"


def streamed_documents(spark, sf_dir):
    """Current documents after the stream has been written to a table."""
    arriving = stream_lines(spark, sf_dir).withColumn("_seq", F.col("event_id"))
    path = _streamed(spark, arriving, rejects=shared_folder(spark, "stream-rejects"))
    return _key_columns(read_documents(spark, path))


def streamed_places(spark, sf_dir):
    """Places of the stream's documents, with a range table that is not broadcast."""
    arriving = stream_lines(spark, sf_dir).withColumn("_seq", F.col("event_id"))
    path = _streamed(spark, arriving, ranges=nation_ranges(spark, sf_dir), broadcast_bytes=-1)
    return _places(read_documents(spark, path))


def streamed_files(spark, sf_dir):
    """Documents of closed text files, a few files in each micro-batch."""
    path = _as_text(lines(spark, sf_dir), spark)
    found = read_documents(spark, _streamed(spark, stream_access_log(spark, path, max_files=3)))
    return found.select("_index", "_id", "`@hostname`").withColumnRenamed("@hostname", "hostname")


def streamed_table_stats(spark, sf_dir):
    """Statistics that follow the table of documents instead of the lines."""
    arriving = stream_lines(spark, sf_dir).withColumn("_seq", F.col("event_id"))
    folder, path = shared_folder(spark, "stream-stats"), _streamed(spark, arriving)
    place = (f"{folder}/metrics", f"{folder}/checkpoint", PREFIX)
    stream_stats(stream_versions(spark, path), *place, interval=3600, trigger=None).awaitTermination()
    flush_stats(spark, *place)
    return read_metrics(spark, f"{folder}/metrics").selectExpr("name", "value", "time AS bucket")


def streamed_growing(spark, sf_dir):
    """Documents of files that are appended to between two triggers, the second time to their end.

    Every task keeps a file of its own and cuts the first part within a line.
    """
    folder = shared_folder(spark, "growing").removeprefix("file:")
    os.makedirs(f"{folder}/log")
    text = lines(spark, sf_dir).select("value").repartition(spread(spark, sf_dir, 4), "value").sortWithinPartitions("value")

    def append(half):
        def run(batches):
            from pyspark import TaskContext

            with open(f"{folder}/log/access-{TaskContext.get().partitionId()}.log", "ab") as file:
                for n, batch in enumerate(batches):
                    whole = "".join(f"{line}\n" for line in batch["value"].to_pylist()).encode()
                    cut = len(whole) // 2 + 1 if n == 0 else 0
                    if n == 0:  # a task that runs again goes on where the first part ended
                        file.truncate(cut * half)
                    file.write(whole[:cut] if half == 0 else whole[cut:])
                    yield batch.slice(0, 0)

        return run

    for half in (0, 1):
        text.mapInArrow(append(half), "value string").write.format("noop").mode("overwrite").save()
        query = stream_upsert(
            follow_access_log(spark, f"{folder}/log/access-*.log", start="earliest"),
            f"{folder}/documents", f"{folder}/checkpoint", trigger=None, hostname=HOSTNAME,
        )
        query.awaitTermination()
    return read_versions(spark, f"{folder}/documents").selectExpr("_index", "_id", "host", "CAST(status AS BIGINT) AS status")


def queries() -> dict[str, Query]:
    return {
        "parse_core": parse_core,
        "dash_prune": dash_prune,
        "quarantine": quarantine,
        "request_split": request_split,
        "uri_split": uri_split,
        "log_uri": log_uri,
        "query_multimap": query_multimap,
        "query_key_rename": query_key_rename,
        "query_geo": query_geo,
        "path_segments": path_parts,
        "upstream_lists": upstream_lists,
        "upstream_numeric": upstream_numeric,
        "extra_fields": extra_fields,
        "timestamp_formats": timestamp_formats,
        "geoip_join": geo_lookup,
        "geoip_join_shuffled": geo_lookup_shuffled,
        "geoip_merge": geo_merge,
        "geoip_absent": geo_lookup_absent,
        "time_range": in_time_range,
        "status_filter": status_filter,
        "extension_transforms": extension_transforms,
        "extension_in_python": extension_in_python,
        "index_route": index_route,
        "document_envelope": document_envelope,
        "document_lines": document_lines,
        "upsert_latest": upsert_latest,
        "compacted_dates": compacted_dates,
        "declared_table": declared_table,
        "extension_documents": extension_documents,
        "index_with_rejects": index_with_rejects,
        "text_scan": text_scan,
        "invalid_bytes": invalid_bytes,
        "timestamp_parser": timestamp_parser,
        "interval_bucket": interval_bucket,
        "path_normalise": path_normalise,
        "latency_bin": latency_bins,
        "stats_request_time": _stats("request_time", 10),
        "stats_request_time_month": _stats("request_time", MONTH),
        "stats_upstream": _stats("upstream_response_time", 10),
        "stats_upstream_month": _stats("upstream_response_time", MONTH),
        "stats_bytes": _stats("bytes_sent", 10),
        "stats_bytes_month": _stats("bytes_sent", MONTH),
        "stats_all": _stats(None, 10),
        "stats_all_month": _stats(None, MONTH),
        "metric_lines": _metric_lines(10),
        "metric_lines_month": _metric_lines(MONTH),
        "stream_stats": streamed_stats,
        "stream_stats_flushed": streamed_stats_flushed,
        "stream_late": streamed_late,
        "stream_table_stats": streamed_table_stats,
        "stream_upsert": streamed_documents,
        "stream_geoip": streamed_places,
        "stream_files": streamed_files,
        "stream_growing": streamed_growing,
    }
