"""The same queries as plain SQL, each written for itself, not from the library."""

from __future__ import annotations

from checks.lines import ORACLE_LINES

# The fields that are read as text first.
_TEXT_FIELDS = (
    "request_id",
    "remote_addr",
    "host",
    "status",
    "request",
    "request_uri",
    "request_time",
    "gzip_ratio",
    "request_length",
    "connection_requests",
    "bytes_sent",
    "connection",
    "forwarded_for",
    "upstream_addr",
    "upstream_status",
    "upstream_response_time",
    "upstream_connect_time",
    "upstream_response_length",
    "upstream_cache_status",
)

_FIELDS = ",\n  ".join(
    f"nullif(nullif(doc->>'$.{f}', '-'), '') AS {f}" for f in _TEXT_FIELDS
)


def _int(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN CAST(trim({c}) AS BIGINT) END"


def _list(c: str) -> str:
    items = f"[trim(x) for x in string_split(replace({c}, ', ', ' : '), ' : ')]"
    kept = f"[y for y in {items} if y NOT IN ('', '-')]"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} END"


_BASE = f"""
WITH lines AS ({ORACLE_LINES}),
decoded AS (
  SELECT event_id, value, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM lines
),
texts AS (
  SELECT event_id, value, doc, doc->>'$.timestamp' AS stamp,
  {_FIELDS}
  FROM decoded
),
typed AS (
  SELECT * REPLACE (
    {_int('status')} AS status, {_int('request_length')} AS request_length,
    {_int('connection_requests')} AS connection_requests, {_int('bytes_sent')} AS bytes_sent,
    {_int('connection')} AS connection,
    TRY_CAST(request_time AS DOUBLE) AS request_time, TRY_CAST(gzip_ratio AS DOUBLE) AS gzip_ratio,
    {_list('forwarded_for')} AS forwarded_for, {_list('upstream_addr')} AS upstream_addr,
    {_list('upstream_status')} AS upstream_status,
    CAST({_list('upstream_response_time')} AS DOUBLE[]) AS upstream_response_time,
    CAST({_list('upstream_connect_time')} AS DOUBLE[]) AS upstream_connect_time,
    CAST({_list('upstream_response_length')} AS BIGINT[]) AS upstream_response_length
  ),
  TRY_CAST(substr(stamp, 1, 19) AS TIMESTAMP) AS wall,
  CASE WHEN substr(stamp, 20) IN ('Z', '') THEN 0 ELSE CAST(substr(stamp, 20, 3) AS INT) * 3600 END AS shift,
  bytes_sent AS bytes_text, request_time AS time_text
  FROM texts
),
marked AS (
  SELECT *, CAST(epoch(wall) AS BIGINT) - shift AS epoch,
    CASE WHEN doc IS NULL THEN 'json' WHEN wall IS NULL THEN 'timestamp'
         WHEN bytes_text IS NOT NULL AND bytes_sent IS NULL THEN 'bytes_sent'
         WHEN time_text IS NOT NULL AND request_time IS NULL THEN 'request_time' END AS problem
  FROM typed
),
requests AS (
  SELECT * REPLACE (
      CASE WHEN request_uri IS NOT NULL OR len(tokens) <> 3 THEN request END AS request,
      CASE WHEN request_uri IS NOT NULL THEN request_uri WHEN len(tokens) = 3 THEN tokens[2] END AS request_uri
    ),
    CASE WHEN request_uri IS NULL AND len(tokens) = 3 THEN tokens[3] END AS server_protocol
  FROM (SELECT *, regexp_split_to_array(trim(request), '\\s+') AS tokens FROM marked WHERE problem IS NULL)
),
ok AS (
  SELECT *, string_split(request_path, '/') AS parts,
    nullif(string_split(request_path, '/')[2], '') AS request_path_1,
    nullif(string_split(request_path, '/')[3], '') AS request_path_2
  FROM (
    SELECT *,
      CASE WHEN contains(request_uri, '?') THEN regexp_replace(request_uri, '\\?[^?]*$', '') ELSE request_uri END AS request_path,
      CASE WHEN contains(request_uri, '?') THEN regexp_extract(request_uri, '\\?([^?]*)$', 1) END AS request_qs
    FROM requests
  )
)
"""

_PAIRS = """,
pairs AS (
  SELECT source, pos,
    url_decode(replace(split_part(item, '=', 1), '+', ' ')) AS k,
    url_decode(replace(substr(item, strpos(item, '=') + 1), '+', ' ')) AS v
  FROM (SELECT source, unnest(string_split(qs, '&')) AS item, generate_subscripts(string_split(qs, '&'), 1) AS pos FROM strings)
  WHERE contains(item, '=') AND length(substr(item, strpos(item, '=') + 1)) > 0
),
names AS (SELECT source, k, replace(k, '.', '_') AS o, min(pos) AS first_pos FROM pairs GROUP BY ALL),
winners AS (
  SELECT source, o, coalesce(arg_max(k, first_pos) FILTER (WHERE contains(k, '.')), o) AS k FROM names GROUP BY source, o
),
entries AS (
  SELECT w.source, w.o AS key, p.v AS value, row_number() OVER (PARTITION BY w.source, w.o ORDER BY p.pos) - 1 AS pos
  FROM winners w JOIN pairs p ON p.source = w.source AND p.k = w.k
)
"""

_LOG_STRINGS = """,
strings AS (SELECT event_id AS source, request_qs AS qs FROM ok WHERE request_qs IS NOT NULL)
"""

_BOTH_STRINGS = """,
strings AS (
  SELECT concat('e', CAST(event_id AS VARCHAR)) AS source, request_qs AS qs FROM ok WHERE request_qs IS NOT NULL
  UNION ALL
  SELECT concat('p', CAST(page_id AS VARCHAR)), regexp_extract(url, '\\?([^?]*)$', 1) FROM pages WHERE contains(url, '?')
)
"""


def _label(c: str) -> str:
    uuid = "[A-Fa-f0-9]{8}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{12}"
    return (
        f"coalesce(regexp_replace(regexp_replace({c}, '{uuid}', '<uuid>', 'g'), "
        f"'^[0-9]+$', '<id>'), '#')"
    )


def _bin(c: str) -> str:
    step = f"CASE WHEN {c} > 0 THEN CAST(trunc(log10({c}) * 10) AS INT) ELSE -31 END"
    return f"CAST(CAST(floor(pow(10.0::DOUBLE, ({step}) / 10.0::DOUBLE) * 1000) AS BIGINT) AS VARCHAR)"


_HITS = f""",
hits AS (
  SELECT event_id, epoch, host, {_label('request_path_1')} AS p1, {_label('request_path_2')} AS p2,
    status, coalesce(upstream_cache_status, 'NONE') AS cache, request_time,
    upstream_response_time[-1] AS upstream, bytes_sent,
    {_bin('request_time')} AS request_bin, {_bin('upstream_response_time[-1]')} AS upstream_bin
  FROM ok WHERE host IS NOT NULL AND status IS NOT NULL AND status <> 0
)
"""


def _stats(interval: int) -> str:
    """The long result with numeric values; one aggregation per metric."""
    bucket = f"epoch - epoch % {interval}"
    dims = "host, p1 AS request_path_1, p2 AS request_path_2, status"
    keys = "bucket, host, p1, p2, status"
    return f""",
timed AS (SELECT {bucket} AS bucket, * FROM hits),
by_request AS (
  SELECT bucket, {dims}, cache AS upstream_cache_status, request_bin AS bin,
    coalesce(sum(request_time), 0.0) AS total, count(request_time) AS n
  FROM timed GROUP BY {keys}, cache, request_bin
),
by_upstream AS (
  SELECT bucket, {dims}, upstream_bin AS bin, sum(upstream) AS total, count(upstream) AS n
  FROM timed WHERE upstream IS NOT NULL GROUP BY {keys}, upstream_bin
),
by_bytes AS (
  SELECT bucket, {dims}, coalesce(sum(bytes_sent), 0) AS total FROM timed GROUP BY {keys}
),
stats AS (
  SELECT bucket, 'request_time' AS metric, 'sum' AS agg, host, request_path_1, request_path_2, status,
    upstream_cache_status, bin, CAST(total AS DOUBLE) AS value FROM by_request
  UNION ALL
  SELECT bucket, 'request_time', 'count', host, request_path_1, request_path_2, status,
    upstream_cache_status, bin, n FROM by_request
  UNION ALL
  SELECT bucket, 'upstream_response_time', 'sum', host, request_path_1, request_path_2, status,
    NULL, bin, total FROM by_upstream
  UNION ALL
  SELECT bucket, 'upstream_response_time', 'count', host, request_path_1, request_path_2, status,
    NULL, bin, n FROM by_upstream
  UNION ALL
  SELECT bucket, 'bytes_sent', NULL, host, request_path_1, request_path_2, status, NULL, NULL, total FROM by_bytes
)
"""


def _stats_query(metric: str | None, interval: int) -> str:
    where = f"WHERE metric = '{metric}'" if metric else ""
    return (
        _BASE
        + _HITS
        + _stats(interval)
        + f"SELECT * REPLACE (printf('%.3f', value) AS value) FROM stats {where}"
    )


_METRIC_LINE = """concat_ws(' ',
    concat_ws('.', 'traffic.web1', metric, agg, replace(host, '.', '_'), replace(request_path_1, '.', '_'),
      replace(request_path_2, '.', '_'), CAST(status AS VARCHAR), replace(upstream_cache_status, '.', '_'), bin),
    CASE WHEN agg = 'sum' THEN printf('%.3f', value) ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END,
    CAST(bucket AS VARCHAR)) AS value"""


def _metric_query(interval: int) -> str:
    return _BASE + _HITS + _stats(interval) + f"SELECT bucket, {_METRIC_LINE} FROM stats"


_GEO = """
SELECT o.event_id, o.remote_addr, n.n_nationkey + 0.5::DOUBLE AS lat, n.n_nationkey - 0.5::DOUBLE AS lon,
  n.n_name AS city, CASE WHEN n.n_name IS NOT NULL THEN concat('region ', CAST(n.n_regionkey AS VARCHAR)) END AS region_name
FROM ok o LEFT JOIN nation n
  ON split_part(o.remote_addr, '.', 1) = '10'
 AND CAST(split_part(o.remote_addr, '.', 2) AS INT) = n.n_nationkey
 AND CAST(split_part(o.remote_addr, '.', 3) AS INT) < 128
"""

_NETS = """
SELECT o.event_id, o.remote_addr, a + 0.5::DOUBLE AS lat, b + 0.5::DOUBLE AS lon,
  'net.' || CAST(a AS VARCHAR) || '.' || CAST(b AS VARCHAR) AS city, CASE WHEN a IS NOT NULL THEN 'half' END AS region_name
FROM ok o LEFT JOIN (SELECT DISTINCT user_id % 4 AS a, user_id % 256 AS b FROM events WHERE user_id % 2 = 0) n
  ON CAST(split_part(o.remote_addr, '.', 2) AS INT) = a
 AND CAST(split_part(o.remote_addr, '.', 3) AS INT) = b
 AND CAST(split_part(o.remote_addr, '.', 4) AS INT) BETWEEN 64 AND 191
"""

_NAMED = """
SELECT regexp_extract(line.value, '^(.*) (\\S+) (\\S+)$', 1) AS name,
  regexp_extract(line.value, '^(.*) (\\S+) (\\S+)$', 2) AS value, bucket
FROM (SELECT {line}, bucket FROM stats) AS line
"""

_LATEST = """
SELECT 'nginx-' || strftime(wall, '%Y.%m.%d') AS _index, request_id AS _id, event_id, status
FROM ok WHERE request_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY strftime(wall, '%Y.%m.%d'), request_id ORDER BY event_id DESC) = 1
"""


def oracle_sql() -> dict[str, str]:
    month = 2_592_000
    sql = {
        "parse_core": _BASE
        + """SELECT event_id, epoch, strftime(wall, '%Y-%m-%d %H:%M:%S') AS wall_clock, 'web1' AS hostname,
          request_id, status, request_length, connection_requests, bytes_sent, connection,
          printf('%.3f', request_time) AS request_time, printf('%.3f', gzip_ratio) AS gzip_ratio FROM ok""",
        "dash_prune": _BASE
        + """SELECT event_id, host, upstream_cache_status,
          nullif(nullif(doc->>'$.http_user_agent', '-'), '') AS http_user_agent,
          connection_requests IS NULL AS no_connection_requests FROM ok""",
        "quarantine": _BASE
        + """SELECT event_id, value, coalesce(problem, 'request_id') AS errors
          FROM marked WHERE problem IS NOT NULL OR request_id IS NULL""",
        "request_split": _BASE
        + "SELECT event_id, request, request_uri, server_protocol FROM ok",
        "uri_split": """SELECT page_id,
          CASE WHEN contains(url, '?') THEN regexp_replace(url, '\\?[^?]*$', '') ELSE url END AS path,
          CASE WHEN contains(url, '?') THEN regexp_extract(url, '\\?([^?]*)$', 1) END AS qs FROM pages""",
        "log_uri": _BASE
        + "SELECT event_id, request_path, request_qs, request_path_1, request_path_2 FROM ok",
        "query_multimap": _BASE
        + _BOTH_STRINGS
        + _PAIRS
        + "SELECT source, key, pos, value FROM entries",
        "query_key_rename": _BASE
        + _LOG_STRINGS
        + _PAIRS
        + """SELECT source AS event_id, key, string_agg(value, '|' ORDER BY pos) AS joined
          FROM entries GROUP BY source, key""",
        "query_geo": _BASE
        + _LOG_STRINGS
        + _PAIRS
        + """SELECT event_id, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS lat,
            CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS lon
          FROM (
            SELECT s.source AS event_id,
              TRY_CAST(max(value) FILTER (WHERE key = 'lat' AND pos = 0) AS DOUBLE) AS lat,
              TRY_CAST(CASE WHEN count(*) FILTER (WHERE key = 'lng') > 0
                THEN max(value) FILTER (WHERE key = 'lng' AND pos = 0)
                ELSE max(value) FILTER (WHERE key = 'lon' AND pos = 0) END AS DOUBLE) AS lon
            FROM strings s LEFT JOIN entries e ON e.source = s.source GROUP BY s.source)""",
        "path_segments": _BASE
        + """SELECT source, n, seg FROM (
            SELECT concat('e', CAST(event_id AS VARCHAR)) AS source, unnest(parts) AS seg,
              generate_subscripts(parts, 1) - 1 AS n FROM ok
            UNION ALL
            SELECT concat('p', CAST(page_id AS VARCHAR)), unnest(parts), generate_subscripts(parts, 1) - 1
            FROM (SELECT page_id, string_split(CASE WHEN contains(url, '?')
                    THEN regexp_replace(url, '\\?[^?]*$', '') ELSE url END, '/') AS parts FROM pages)
          ) WHERE seg <> ''""",
        "upstream_lists": _BASE
        + """SELECT event_id, array_to_string(forwarded_for, '|') AS forwarded_for,
          array_to_string(upstream_addr, '|') AS upstream_addr,
          array_to_string(upstream_status, '|') AS upstream_status FROM ok""",
        "upstream_numeric": _BASE
        + """SELECT event_id,
          array_to_string([printf('%.3f', x) for x in upstream_response_time], '|') AS upstream_response_time,
          array_to_string([printf('%.3f', x) for x in upstream_connect_time], '|') AS upstream_connect_time,
          array_to_string(upstream_response_length, '|') AS upstream_response_length FROM ok""",
        "extra_fields": _BASE
        + """SELECT event_id, key, value FROM (
            SELECT event_id, unnest(['http_user_agent', 'tcp_rtt', 'tls', 'props', 'tag']) AS key,
              unnest([doc->'$.http_user_agent', doc->'$.tcp_rtt', doc->'$.tls', doc->'$.props', doc->'$.tag'])::VARCHAR AS value
            FROM ok) WHERE value IS NOT NULL AND value NOT IN ('"-"', '""')""",
        "timestamp_formats": """SELECT event_id,
          CAST(epoch(date_trunc('second', ts)) AS BIGINT) - CASE WHEN user_id % 2 = 0 THEN 10800 ELSE -18000 END AS epoch,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS wall_clock FROM events""",
        "geoip_join": _BASE + _GEO,
        "geoip_join_shuffled": _BASE + _GEO,
        "geoip_merge": _BASE + _NETS,
        "geoip_absent": _BASE
        + """SELECT event_id, remote_addr, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon,
          CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS region_name FROM ok""",
        "time_range": _BASE
        + """SELECT event_id, epoch FROM ok
          WHERE epoch >= epoch(TIMESTAMP '2024-01-05 00:00:00') AND epoch < epoch(TIMESTAMP '2024-01-20 12:00:00')""",
        "status_filter": _BASE
        + """SELECT host, status, count(*) AS hits FROM ok
          WHERE host IS NOT NULL AND status IS NOT NULL AND status <> 0 GROUP BY host, status""",
        "extension_transforms": _BASE
        + """SELECT event_id, coalesce(request_time > 0.5, FALSE) AS slow, status FROM ok WHERE status >= 500""",
        "extension_in_python": _BASE
        + "SELECT event_id, lower(coalesce(upstream_cache_status, 'none')) AS family FROM ok",
        "index_route": _BASE
        + """SELECT 'log-' || strftime(wall, '%Y.%m.%d-%j') AS _index, count(*) AS n, min(event_id) AS first_event
          FROM ok GROUP BY 1""",
        "document_envelope": _BASE
        + """SELECT request_id AS _id, 'nginx-' || strftime(wall, '%Y.%m.%d') AS _index, 'access_log' AS _type,
          event_id, host, request_path FROM ok WHERE request_id IS NOT NULL""",
        "document_lines": _BASE
        + _LOG_STRINGS
        + _PAIRS
        + """,
        points AS (
          SELECT source, max(value) FILTER (WHERE key = 'lat' AND pos = 0) AS lat,
            coalesce(max(value) FILTER (WHERE key = 'lng' AND pos = 0), max(value) FILTER (WHERE key = 'lon' AND pos = 0)) AS lon,
            to_json(list(value ORDER BY pos) FILTER (WHERE key = 'a_b'))::VARCHAR AS a_b
          FROM entries GROUP BY source
        )
        SELECT request_id AS id, 'nginx-' || strftime(wall, '%Y.%m.%d') AS idx,
          replace(stamp, 'Z', '+00:00') AS ts, 'web1' AS web, request_uri AS uri, request_path_1 AS path_1,
          nullif(parts[5], '') AS path_4, a_b,
          CASE WHEN TRY_CAST(lon AS DOUBLE) IS NOT NULL THEN CAST(TRY_CAST(lat AS DOUBLE) AS VARCHAR) END AS lat,
          to_json(upstream_addr)::VARCHAR AS upstreams, CAST(bytes_sent AS VARCHAR) AS bytes,
          doc->>'$.tcp_rtt' AS rtt, doc->>'$.tls' AS tls, doc->>'$.props' AS props
        FROM ok LEFT JOIN points ON source = event_id WHERE request_id IS NOT NULL""",
        "upsert_latest": _BASE + _LATEST,
        "interval_bucket": _BASE
        + "SELECT epoch - epoch % 10 AS bucket, count(*) AS n FROM ok GROUP BY 1",
        "path_normalise": _BASE
        + f"""SELECT event_id, {_label('request_path_1')} AS p1, {_label('request_path_2')} AS p2,
          coalesce(upstream_cache_status, 'NONE') AS cache FROM ok""",
        "latency_bin": _BASE
        + f"""SELECT event_id, {_bin('request_time')} AS request_bin,
          {_bin('upstream_response_time[-1]')} AS upstream_bin FROM ok""",
        "stats_request_time": _stats_query("request_time", 10),
        "stats_request_time_month": _stats_query("request_time", month),
        "stats_upstream": _stats_query("upstream_response_time", 10),
        "stats_upstream_month": _stats_query("upstream_response_time", month),
        "stats_bytes": _stats_query("bytes_sent", 10),
        "stats_bytes_month": _stats_query("bytes_sent", month),
        "stats_all": _stats_query(None, 10),
        "stats_all_month": _stats_query(None, month),
        "metric_lines": _metric_query(10),
        "metric_lines_month": _metric_query(month),
        # Only intervals the watermark has passed: five seconds behind the
        # newest record that counts.
        "stream_stats": _BASE
        + _HITS
        + _stats(3600)
        + f"""SELECT {_METRIC_LINE} FROM stats
          WHERE bucket + 3600 <= (SELECT max(epoch) FROM hits) - 5""",
        "stream_stats_flushed": _BASE + _HITS + _stats(3600) + _NAMED.format(line=_METRIC_LINE),
        "stream_table_stats": _BASE
        + _HITS.replace("WHERE host", "WHERE request_id IS NOT NULL AND host")
        + _stats(3600)
        + _NAMED.format(line=_METRIC_LINE),
        "stream_late": _BASE
        + _HITS
        + """SELECT epoch - epoch % 3600 AS bucket, count(*) AS n FROM hits
          WHERE event_id % 10 = 0 AND epoch - epoch % 3600 + 3600 <=
            (SELECT max(epoch) FROM hits WHERE event_id % 10 <> 0) - 5 GROUP BY 1""",
        "stream_upsert": _BASE + _LATEST,
        "compacted_dates": _BASE + _LATEST,
        "declared_table": _BASE + _LATEST,
        "extension_documents": _BASE
        + f"""SELECT _id AS id, event_id,
            CASE WHEN event_id % 2 = 0 THEN CAST(coalesce(request_time > 0.5, FALSE) AS VARCHAR) END AS slow,
            CASE WHEN event_id % 2 = 0 THEN printf('%.3f', request_time) END AS total,
            CASE WHEN event_id % 2 = 0 THEN CAST(status AS VARCHAR) END AS code
          FROM ({_LATEST}) JOIN (SELECT event_id, request_time FROM ok) USING (event_id)""",
        "index_with_rejects": _BASE
        + """SELECT 'nginx-' || strftime(wall, '%Y.%m.%d') AS place, request_id AS text, CAST(NULL AS VARCHAR) AS errors
          FROM ok WHERE request_id IS NOT NULL AND epoch >= epoch(TIMESTAMP '2024-01-05 00:00:00')
          UNION ALL
          SELECT 'all', value, coalesce(problem, 'request_id') FROM marked WHERE problem IS NOT NULL OR request_id IS NULL""",
        "text_scan": _BASE + "SELECT request_id, epoch, host, status FROM ok",
        "invalid_bytes": """SELECT 'e' || CAST(event_id AS VARCHAR) AS request_id,
          'h' || CASE WHEN event_id % 3 = 2 THEN 'é' ELSE chr(65533) END || CAST(user_id % 5 AS VARCHAR) AS host FROM events""",
        "timestamp_parser": """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch,
            strftime(date_trunc('second', ts) + CASE WHEN event_id % 2 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL (-3) HOUR END,
              '%Y-%m-%d %H:%M:%S') AS wall_clock
          FROM events WHERE event_id % 7 <> 0""",
        "stream_geoip": _BASE
        + f"""SELECT * FROM ({_GEO}) WHERE event_id IN (SELECT event_id FROM ({_LATEST}))""",
        "stream_files": _BASE
        + """SELECT DISTINCT 'nginx-' || strftime(wall, '%Y.%m.%d') AS _index, request_id AS _id, 'web1' AS hostname
          FROM ok WHERE request_id IS NOT NULL""",
        "stream_growing": _BASE
        + """SELECT 'nginx-' || strftime(wall, '%Y.%m.%d') AS _index, request_id AS _id, host, status
          FROM ok WHERE request_id IS NOT NULL""",
    }
    return sql
