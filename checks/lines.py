"""An access log derived from the ``events`` table, one JSON line per event.

One SQL text serves Spark and the SQL engine of the checks; ``{...}`` marks the
few places where their function names differ. Both give the same line for
every event, so the checks start from equal text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Lines that one task derives and decodes.
LINES = 250_000

_LINES = """
SELECT event_id, CASE
  WHEN event_id % 211 = 0 THEN '{{bad'
  WHEN event_id % 223 = 0 THEN ''
  WHEN event_id % 227 = 0 THEN concat('{{"request_id":"r', {s_id}, '","host":"h0.example.com","status":200}}')
  WHEN event_id % 229 = 0 THEN concat('{{"timestamp":"-","request_id":"r', {s_id}, '","status":200}}')
  WHEN event_id % 233 = 0 THEN concat('{{"timestamp":"', {stamp}, 'Z","host":"h1.example.com","status":200,"request_time":"0.010","bytes_sent":"10"}}')
  WHEN event_id % 239 = 0 THEN concat('{{"timestamp":"', {stamp}, 'Z","request_id":"r', {s_id}, '","host":"h1.example.com","status":200,"bytes_sent":"12.5"}}')
  WHEN event_id % 241 = 0 THEN concat('{{"timestamp":"', {stamp}, 'Z","request_id":"r', {s_id}, '","host":"h1.example.com","status":200,"request_time":"1d"}}')
  WHEN event_id % 251 = 0 THEN concat('{{"timestamp":"', {stamp}, 'Z","request_id":"r', {s_id}, '","status":200}} tail')
  WHEN event_id % 257 = 0 THEN concat('{{"timestamp":"', {stamp}, 'Z","request_id":"r', {s_id}, '","host":null,"status":"200","request_uri":"/u?x=1?y=2&y=3","request":"GET /other HTTP/1.0","request_time":null,"tag":null}}')
  ELSE {object}(
 'timestamp', concat({stamp}, CASE user_id % 3 WHEN 0 THEN '+00:00' WHEN 1 THEN '+03:00' ELSE '-05:00' END),
 'request_id', concat('r', CAST(CASE WHEN event_id % 50 = 49 THEN event_id-1 ELSE event_id END AS {str})),
 'remote_addr', concat('10.', CAST(user_id % 4 AS {str}), '.', CAST(user_id % 256 AS {str}), '.', CAST(event_id % 256 AS {str})),
 'host', CASE WHEN event_id % 41 = 0 THEN '-' ELSE concat('h', CAST(user_id % 5 AS {str}), '.example.com') END,
 'request', CASE WHEN event_id % 101 = 0 THEN '-' WHEN event_id % 109 = 0 THEN 'GET /short' ELSE concat('GET /', event_type, '/',
    CASE event_id % 3 WHEN 0 THEN CAST(user_id AS {str}) WHEN 1 THEN 'x-123e4567-e89b-12d3-a456-426614174000' ELSE 'list//deep' END,
    CASE WHEN event_id % 4 = 0 THEN concat('?a.b=', CAST(event_id % 9 AS {str}), '&a.b=z%20', CAST(user_id AS {str}), '&a_b=plain&blank=&flag&q=a+b%2Bc%zz',
         '&lat=55.', CAST(user_id % 10 AS {str}), '&', CASE WHEN event_id % 16 = 4 THEN 'lon' ELSE 'lng' END, '=', CASE WHEN event_id % 8 = 0 THEN 'bad' ELSE '37.5' END) ELSE '' END,
    ' HTTP/1.1') END,
 'status', CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_type = 'error' THEN 502 ELSE 200 END,
 'request_time', CASE WHEN event_id % 103 = 0 THEN '-' ELSE printf('%.3f', floor(value*10)/1000.0{dbl}) END,
 'gzip_ratio', CASE WHEN event_id % 3 = 0 THEN '-' ELSE printf('%.2f', floor(value*10)/100.0{dbl}) END,
 'request_length', event_id % 700 + 80,
 'bytes_sent', CASE WHEN event_id % 107 = 0 THEN '-' ELSE CAST(event_id * 7 % 5000 AS {str}) END,
 'connection', CAST(user_id * 31 AS {str}),
 'connection_requests', CASE WHEN event_id % 11 = 0 THEN '' ELSE ' 3 ' END,
 'forwarded_for', CASE event_id % 5 WHEN 0 THEN '-' WHEN 1 THEN '192.0.2.1, 192.0.2.2' WHEN 2 THEN '192.0.2.1,192.0.2.2' ELSE '192.0.2.9' END,
 'upstream_cache_status', CASE event_id % 4 WHEN 0 THEN 'HIT' WHEN 1 THEN 'MISS' WHEN 2 THEN 'EXPIRED' ELSE '-' END,
 'upstream_addr', CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN '10.0.0.1:80, 10.0.0.2:80 : 10.0.0.3:80' ELSE '10.0.0.1:80' END,
 'upstream_status', CASE WHEN event_id % 7 = 0 THEN '-, -' WHEN event_id % 5 = 0 THEN '502, 504 : 200' ELSE '200' END,
 'upstream_response_time', CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN concat('0.001, - : ', printf('%.3f', floor(value*9)/1000.0{dbl})) ELSE printf('%.3f', floor(value*9)/1000.0{dbl}) END,
 'upstream_connect_time', CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN '0.001, 0.002 : 0.250' ELSE '0.004' END,
 'upstream_response_length', CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN concat('0, 0 : ', CAST(event_id % 900 AS {str})) ELSE CAST(event_id % 900 AS {str}) END,
 'http_user_agent', CASE WHEN event_id % 13 = 0 THEN '-' ELSE concat('agent/', CAST(user_id % 7 AS {str})) END,
 'tcp_rtt', event_id % 1000,
 'tls', event_id % 2 = 0,
 'props', props
){text} END AS value
FROM events
"""


def _lines(**words: str) -> str:
    words["s_id"] = f"CAST(event_id AS {words['str']})"
    return _LINES.format(**words)


SPARK_LINES = _lines(
    stamp="""date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")""",
    object="to_json(named_struct",
    text=")",
    str="STRING",
    dbl="D",
)
ORACLE_LINES = _lines(
    stamp="strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    object="CAST(json_object",
    text=" AS VARCHAR)",
    str="VARCHAR",
    dbl="::DOUBLE",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, least: int) -> int:
    """How many tasks share the events: ``least``, or more so that none has more than ``LINES``."""
    return max(least, -(-table(spark, sf_dir, "events").count() // LINES))


def events_for_all_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt evenly over tasks of at most about ``LINES``.

    Splits of the file say nothing of that: a row group is read by one task, however
    many splits it spans, and a small row becomes a line thirty times its size.
    """
    tasks = spread(spark, sf_dir, spark.sparkContext.defaultParallelism)
    return table(spark, sf_dir, "events").repartition(tasks, "event_id")


def access_log_from_events(events: DataFrame) -> DataFrame:
    """``event_id`` and ``value`` for every row of a batch or streaming table."""
    body = SPARK_LINES.strip().removeprefix("SELECT").removesuffix("FROM events")
    event_id, line = body.split(",", 1)
    return events.selectExpr(event_id, line)
