"""Inputs for the registered queries, derived by Spark from the given tables.

``VIEWS`` hold relational inputs as SQL that both engines understand; ``{T}``
and ``{S}`` stand for the names of the timestamp and text types.  ``DOCUMENTS``
build one text document per row of a table, so their number grows with it.
"""

import re

from pyspark.sql import functions as F

from lanternstats.functions.text import bind

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "v_status": """
SELECT CAST(date_trunc('hour', ts) AS {T}) AS validafter, user_id AS fingerprint,
 max(user_id + 150 * (event_id % 10)) AS descriptor,
 max(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) = 1 AS isrunning,
 max(CASE WHEN event_type IN ('click','purchase') THEN 1 ELSE 0 END) = 1 AS isexit,
 max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) = 1 AS isguard,
 max(CASE WHEN value > 20 THEN 1 ELSE 0 END) = 1 AS isfast,
 max(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) = 1 AS isstable,
 user_id % 50 = 0 AS isauthority,
 max(CASE WHEN event_id % 4 < 2 THEN 9030 ELSE 0 END) AS dirport
FROM events GROUP BY 1, 2""",
    "v_descriptor": """
SELECT c_custkey AS descriptor,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('Rly 0.2.', CAST(c_nationkey % 3 AS {S}), '.19 on ',
  CASE c_custkey % 5 WHEN 0 THEN 'Linux x86_64' WHEN 1 THEN 'Darwin i386' WHEN 2 THEN 'FreeBSD amd64'
   WHEN 3 THEN 'Windows XP' ELSE 'SunOS' END) END AS platform,
 CAST(floor(abs(c_acctbal) * 100) AS BIGINT) AS bandwidthavg,
 CAST(floor(abs(c_acctbal) * 150) AS BIGINT) AS bandwidthburst,
 CAST(floor(abs(c_acctbal) * (50 + c_custkey % 100)) AS BIGINT) AS bandwidthobserved
FROM customer WHERE c_custkey % 10 <> 9""",
    "v_bwhist": """
SELECT user_id AS fingerprint, event_id AS extrainfo, CAST(date_trunc('hour', ts) AS {T}) AS intervalend,
 CAST(floor(value * 10) AS BIGINT) AS read, CAST(floor(value * 8) AS BIGINT) + user_id AS written,
 CASE WHEN user_id % 3 = 0 THEN CAST(floor(value) AS BIGINT) END AS dirread,
 CASE WHEN user_id % 3 = 0 THEN CAST(floor(value * 2) AS BIGINT) END AS dirwritten
FROM events""",
    "v_dirreq": """
SELECT user_id AS source, CAST(date_trunc('minute', ts) AS {T}) AS statsend,
 CASE WHEN user_id % 2 = 0 THEN 86400 ELSE 43200 END AS seconds,
 CASE event_id % 4 WHEN 0 THEN 'zy' WHEN 1 THEN 'de' WHEN 2 THEN 'us' ELSE 'fr' END AS country,
 max(CAST(floor(value) AS BIGINT) + 1) AS requests
FROM events GROUP BY 1, 2, 3, 4""",
    "v_timing": """
SELECT event_type AS source, CAST(date_trunc('second', ts) AS {T}) AS started,
 max(CAST(floor(value * 1000) AS BIGINT)) AS completemillis
FROM events GROUP BY 1, 2""",
    "v_updates": """
SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE event_id % 1000 = 7""",
    "v_ip_ranges": " UNION ALL ".join(
        f"""
SELECT '2010010{1 + v}' AS version, s_suppkey * 1000 + {v * 300} AS from_ip,
 s_suppkey * 1000 + {v * 300 + 599} AS to_ip, concat('C', CAST(s_nationkey % 10 AS {{S}})) AS country
FROM supplier WHERE (s_suppkey + {v}) % 4 <> 0"""
        for v in range(3)
    ),
    "v_ips": """
SELECT o_orderkey AS req_id, o_orderkey * 7 % (SELECT max(s_suppkey) * 1100 FROM supplier) AS ip,
 concat('2010010', CAST(1 + o_custkey % 5 AS {S})) AS day FROM orders""",
    "v_bridge_obs": """
SELECT user_id AS bridge, CAST(ts AS DATE) AS date, CAST(date_trunc('second', ts) AS {T}) AS seen,
 CASE event_id % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'us' ELSE 'fr' END AS country,
 max(CAST(floor(value) AS BIGINT) - 4) AS users
FROM events GROUP BY 1, 2, 3, 4""",
    "v_hashed_relays": """
SELECT DISTINCT user_id AS hashed_relay FROM events WHERE user_id % 9 = 4""",
    "v_broken": """
SELECT DISTINCT user_id AS bridge, CAST(date_trunc('second', ts) AS {T}) AS seen
FROM events WHERE event_id % 5 = 2""",
    "v_vote_flags": """
SELECT l_partkey AS relay, concat('auth', CAST(l_suppkey % 8 AS {S})) AS dir, concat('F', l_returnflag) AS flag
FROM lineitem GROUP BY 1, 2, 3""",
    "v_consensus_flags": """
SELECT l_partkey AS relay, concat('F', l_returnflag) AS flag FROM lineitem WHERE l_partkey % 6 <> 0
GROUP BY 1, 2 HAVING count(DISTINCT l_suppkey) > 1""",
    "v_known_flags": """
SELECT dir, flag FROM (SELECT DISTINCT concat('auth', CAST(l_suppkey % 8 AS {S})) AS dir,
 concat('F', l_returnflag) AS flag FROM lineitem) k
WHERE dir <> 'auth6' AND NOT (dir = 'auth1' AND flag = 'FR')""",
    "v_refs": """
SELECT o_orderkey AS ref_id, CAST(o_orderdate AS DATE) AS published, o_custkey AS doc_id FROM orders""",
    "v_have": """
SELECT c_custkey AS doc_id FROM customer WHERE c_custkey % 10 <> 3""",
    "v_packages": """
SELECT CAST(ts AS DATE) AS date, event_type AS bundle, count(*) AS downloads FROM events
GROUP BY 1, 2""",
}

# ---------------------------------------------------------------- documents

_NL = "chr(10)"
SIGNATURE_TEXT = (
    "concat('router-signature', chr(10), '-----BEGIN SIGNATURE-----', chr(10), 'c2ln', chr(10),"
    " '-----END SIGNATURE-----', chr(10))"
)


def _line(*parts):
    return f"concat({', '.join(parts)}, chr(10))"


_ENTRY = (
    "transform(sequence(1, n), i -> concat("
    "CASE WHEN k % 13 = 0 AND i = 2 THEN concat('r broken x', chr(10)) ELSE "
    "concat('r n', k, 'x', i, ' ', substring(base64(unhex(sha1(concat('id', k, '-', i)))), 1, 27), ' ',"
    " substring(base64(unhex(sha1(concat('d', k, '-', i)))), 1, 27), ' ', o_day, ' 0', i, ':00:00 10.0.', i, '.',"
    " k % 256, ' ', 9001 + i, ' ', (k % 2) * 9030, chr(10)) END,"
    " concat('s', CASE WHEN (k + i) % 11 = 0 THEN ' Authority' ELSE '' END,"
    " CASE WHEN (k + i) % 3 = 0 THEN ' Exit' ELSE '' END, CASE WHEN (k + i) % 2 = 0 THEN ' Fast' ELSE '' END,"
    " CASE WHEN (k + i) % 5 = 0 THEN ' Guard' ELSE '' END, CASE WHEN (k + i) % 4 <> 0 THEN ' Running' ELSE '' END,"
    " CASE WHEN (k + i) % 7 = 0 THEN ' Stable' ELSE '' END, ' Valid', chr(10)),"
    " CASE WHEN (k + i) % 6 <> 0 THEN concat('v Rly 0.2.', (k + i) % 3, '.1', chr(10)) ELSE '' END,"
    " CASE WHEN (k + i) % 5 <> 0 THEN concat('w Bandwidth=', (k * i) % 1000,"
    " CASE WHEN (k + i) % 3 = 1 THEN ' Measured=5' ELSE '' END, chr(10)) ELSE '' END,"
    " CASE WHEN (k + i) % 3 = 0 THEN concat('p accept 80,443', chr(10)) ELSE '' END))"
)

# Header lines of a status that votes and consensuses are compared by.  Both engines can build this text.
HEALTH_LINES = """CASE WHEN k % 4 <> 0 THEN concat('client-versions 0.2.', k % 3, chr(10)) ELSE '' END,
 CASE WHEN k % 5 <> 0 THEN concat('server-versions 0.2.', k % 2, chr(10)) ELSE '' END,
 CASE WHEN k % 6 <> 0 THEN concat('params circwindow=', CASE WHEN k % 4 = 1 THEN 10 ELSE k % 2 END, CASE WHEN k % 7 = 0 THEN ' bogus=1' ELSE '' END, chr(10)) ELSE '' END,
 CASE WHEN k % 9 <> 0 THEN concat('dir-key-expires 2024-02-', lpad(CAST(1 + k % 28 AS {S}), 2, '0'), ' 00:00:00', chr(10)) ELSE '' END"""

# One network status per order: a vote for every third key, some with CRLF line ends, otherwise a consensus.
_STATUS_DOCS = f"""
SELECT k AS doc_id, replace(concat(
 'network-status-version 3', chr(10),
 CASE WHEN k % 3 = 1 THEN concat('vote-status vote', chr(10)) ELSE '' END,
 'valid-after ', o_day, ' ', lpad(CAST(k DIV 3 % 4 * 6 AS STRING), 2, '0'), ':00:00', chr(10),
 CASE WHEN k % 3 = 1 THEN concat('consensus-methods 1 10 ', CAST(k % 12 AS STRING), chr(10))
  ELSE concat('consensus-method ', CAST(k % 12 AS STRING), chr(10)) END,
 {HEALTH_LINES.format(S='STRING')}, 'known-flags Exit Fast Running', chr(10),
 'dir-source a', k % 8, ' FP', (k + 1 - k % 3) % 8, ' 10.0.0.1 80 443', chr(10), 'contact somebody', chr(10),
 CASE WHEN k % 3 <> 1 THEN concat('vote-digest D', k DIV 8 % 2, chr(10), 'dir-source b', k % 8, ' GP', k % 8,
  ' 10.0.0.2 80 443', chr(10), 'contact nobody', chr(10),
  CASE WHEN k % 2 = 0 THEN concat('vote-digest E', k DIV 8 % 2, chr(10)) ELSE '' END)
  ELSE concat('fingerprint KP', k % 8, chr(10)) END,
 array_join({_ENTRY}, ''), 'directory-signature x', chr(10)),
 chr(10), CASE WHEN k % 3 = 1 AND k % 5 = 2 THEN concat(chr(13), chr(10)) ELSE chr(10) END) AS text
FROM (SELECT o_orderkey AS k, CAST(1 + o_orderkey % 4 AS INT) AS n,
 date_format(o_orderdate, 'yyyy-MM-dd') AS o_day FROM orders) o"""

# Server descriptor of a customer; every tenth one lacks its signature.  Both
# engines can build this text, so digests can be compared.
SERVER_TEXT = (
    "concat('router nick', {k}, ' 10.1.', {k} % 250, '.', {k} % 100, ' 9001 7 ', ({k} % 2) * 9030, chr(10),"
    " CASE WHEN {k} % 7 <> 0 THEN concat('platform Rly 0.2.', {k} % 3, '.19 on Linux', chr(10)) ELSE '' END,"
    " 'published 2010-02-0', 1 + {k} % 9, ' 0', {k} % 10, ':00:00', chr(10),"
    " 'opt fingerprint ', upper(substring(sha1(concat('id', {k})), 1, 20)), ' ',"
    " upper(substring(sha1(concat('id', {k})), 21, 20)), chr(10),"
    " CASE WHEN {k} % 3 <> 0 THEN concat('uptime ', {k} * 10, chr(10)) ELSE '' END,"
    " 'bandwidth ', {k} * 3, ' ', {k} * 4, ' ', {k} * 2, chr(10),"
    " CASE WHEN {k} % 4 <> 0 THEN concat('opt extra-info-digest ', upper(sha1(concat('x', {k}))), chr(10)) ELSE '' END,"
    " 'reject *:*', chr(10))"
)
_SERVER_DOCS = f"""
SELECT k AS doc_id, concat({SERVER_TEXT.format(k='k')},
 CASE WHEN k % 10 <> 9 THEN {SIGNATURE_TEXT} ELSE '' END) AS text FROM (SELECT c_custkey AS k FROM customer) c"""

# Extra-info of a customer: histories with late, bad and repeated lines, and request lists.
_values = (
    "array_join(transform(sequence(1, 1 + CAST(k % 5 AS INT)), j -> {e}), ',')"
)
_EXTRA_DOCS = f"""
SELECT k AS doc_id, concat(
 'extra-info nick', k, ' ', upper(sha1(concat('id', k))), chr(10),
 CASE WHEN k % 17 <> 0 THEN concat('published 2010-02-10 0', k % 10, ':00:00', chr(10)) ELSE '' END,
 'write-history ', CASE WHEN k % 11 = 0 THEN '2010-02-01 00:00:00' ELSE '2010-02-09 12:00:00' END, ' (900 s) ',
 {_values.format(e="CASE WHEN k % 13 = 0 AND j = 2 THEN 'x' ELSE CAST(k * 10 + j AS STRING) END")}, chr(10),
 CASE WHEN k % 19 = 0 THEN concat('write-history 2010-02-09 12:00:00 (900 s) 7', chr(10)) ELSE '' END,
 'read-history 2010-02-09 12:00:00 (900 s) ', {_values.format(e="CAST(k * 20 + j AS STRING)")}, chr(10),
 CASE WHEN k % 3 = 0 THEN concat('dirreq-write-history 2010-02-09 12:00:00 (900 s) ',
  {_values.format(e="CAST(k + j AS STRING)")}, chr(10)) ELSE '' END,
 CASE WHEN k % 17 = 0 THEN concat('published 2010-02-10 0', k % 10, ':00:00', chr(10)) ELSE '' END,
 'dirreq-stats-end 2010-02-09 0', k % 10, ':30:00 (86400 s)', chr(10),
 CASE WHEN k % 7 = 0 THEN concat('dirreq-v3-reqs ', chr(10))
  WHEN k % 7 = 1 THEN concat('dirreq-v3-reqs de=8,us=x', chr(10))
  ELSE concat('dirreq-v3-reqs de=', 8 + k % 50, ',us=', 16 + k % 9, ',fr=8', chr(10)) END,
 {SIGNATURE_TEXT}) AS text FROM (SELECT c_custkey AS k FROM customer) c"""

# Bridge extra-info of an order.
_BRIDGE_DOCS = f"""
SELECT k AS doc_id, concat(
 'extra-info nick', k, ' ', upper(sha1(concat('id', k % m))), chr(10),
 CASE WHEN k % 6 <> 0 THEN concat('published 2010-02-', lpad(CAST(1 + k % 28 AS STRING), 2, '0'), ' 12:00:00', chr(10)) ELSE '' END,
 'geoip-start-time 2010-02-', lpad(CAST(1 + k % 28 AS STRING), 2, '0'), ' 0', k % 10, ':00:00', chr(10),
 'geoip-client-origins de=', 8 * (1 + k % 5), ',us=8', chr(10),
 CASE WHEN k % 4 = 0 THEN concat('bridge-stats-end 2010-02-', lpad(CAST(1 + k % 28 AS STRING), 2, '0'), ' 13:00:00 (86400 s)', chr(10)) ELSE '' END,
 'bridge-ips fr=', 8 * (1 + k % 3), ',de=', 16, chr(10), {SIGNATURE_TEXT}) AS text
FROM (SELECT o_orderkey AS k, (SELECT max(c_custkey) FROM customer) AS m FROM orders) o"""

# Bridge status of an order, and bridge descriptors of a customer, for scrubbing.
_BRIDGE_STATUS_DOCS = """
SELECT k AS doc_id, day, array_join(transform(sequence(1, n), i -> concat(
 'r name', i, ' ', substring(base64(unhex(sha1(concat('id', (k + i) % m)))), 1, 27), ' ',
 substring(base64(unhex(sha1(concat('d', k)))), 1, 27), ' 2010-02-0', 1 + (k + i) % m % 9, ' 0', (k + i) % m % 10,
 ':00:00 10.2.3.4 443 0', chr(10), 's ', CASE WHEN (k + i) % 3 = 0 THEN 'Running ' ELSE '' END, 'Valid', chr(10),
 CASE WHEN k % 9 = 0 AND i = 1 THEN concat('v unexpected', chr(10)) ELSE '' END)), '') AS text
FROM (SELECT o_orderkey AS k, CAST(1 + o_orderkey % 4 AS INT) AS n, (SELECT max(c_custkey) FROM customer) AS m,
 CAST(o_orderdate AS DATE) AS day FROM orders) o"""

_BRIDGE_SERVER_DOCS = f"""
SELECT k AS doc_id, concat(CASE WHEN k % 2 = 0 THEN concat('@purpose bridge', chr(10)) ELSE '' END,
 {SERVER_TEXT.format(k='k')}, 'contact me at example', chr(10),
 'family $', upper(sha1(concat('id', k + 1))), ' friend', chr(10), 'onion-key', chr(10), '-----BEGIN RSA PUBLIC KEY-----', chr(10), 'secret', chr(10),
 '-----END RSA PUBLIC KEY-----', chr(10), 'opt hidden-service-dir', chr(10),
 CASE WHEN k % 8 = 3 THEN concat('surprise line', chr(10)) ELSE '' END,
 CASE WHEN k % 10 <> 9 THEN {SIGNATURE_TEXT} ELSE '' END) AS text FROM (SELECT c_custkey AS k FROM customer) c"""

_BRIDGE_EXTRA_DOCS = f"""
SELECT k AS doc_id, concat('extra-info nick', k, ' ', upper(sha1(concat('id', k))), chr(10),
 'published 2010-02-0', 1 + k % 9, ' 0', k % 10, ':00:00', chr(10),
 'write-history 2010-02-01 00:00:00 (900 s) ', k, chr(10), 'dirreq-stats-end x', chr(10),
 'bridge-ips de=', 8 + k % 8, chr(10),
 CASE WHEN k % 12 = 5 THEN concat('surprise line', chr(10)) ELSE '' END, {SIGNATURE_TEXT}) AS text
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 5 <> 2) c"""

# Cached files: copies of a whole text as signed documents, then a truncated one.
_CACHED_FILES = f"""
SELECT doc_id, concat('@type x', chr(10), repeat(concat('router ', text, chr(10), {SIGNATURE_TEXT}), CAST(1 + doc_id % 3 AS INT)),
 'router ', text) AS text FROM documents"""

DOCUMENTS = {
    "status_docs": _STATUS_DOCS,
    "server_docs": _SERVER_DOCS,
    "extra_docs": _EXTRA_DOCS,
    "bridge_docs": _BRIDGE_DOCS,
    "bridge_status_docs": _BRIDGE_STATUS_DOCS,
    "bridge_server_docs": _BRIDGE_SERVER_DOCS,
    "bridge_extra_docs": _BRIDGE_EXTRA_DOCS,
    "cached_files": _CACHED_FILES,
}


def tables(spark, sf_dir, *names):
    """The given tables as DataFrames, registered under their names."""
    frames = []
    for name in names:
        frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        frame.createOrReplaceTempView(name)
        frames.append(frame)
    return frames[0] if len(frames) == 1 else frames


def spread(frame):
    """A table dealt out over the slots of the cluster; one stored as one file would be left to one task."""
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism)


def _source_tables(sql):
    return [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)]


def view(spark, sf_dir, name):
    """A relational input as a DataFrame."""
    sql = VIEWS[name]
    tables(spark, sf_dir, *_source_tables(sql))
    return spark.sql(sql.format(T="TIMESTAMP_NTZ", S="STRING"))


def documents(spark, sf_dir, name):
    """Text documents as ``doc_id``, ``content`` and ``text`` (one character per byte)."""
    sql = DOCUMENTS[name]
    for table in _source_tables(sql):
        spread(tables(spark, sf_dir, table)).createOrReplaceTempView(table)
    frame = spark.sql(sql)
    stored = bind(frame, content=F.encode("text", "UTF-8")).drop("text")
    return bind(stored, text=F.decode("content", "ISO-8859-1"))


def oracle_views(sql):
    """The views named in a query as a WITH clause for the oracle."""
    used, text = [], sql
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            used.append(f"{name} AS ({VIEWS[name].format(T='TIMESTAMP', S='VARCHAR')})")
    return used
