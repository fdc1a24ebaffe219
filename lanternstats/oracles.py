"""SQL twins of the registered queries.

They follow the textbook formulation (outer joins, unions, date fan-out) or
compute the expected rows straight from the tables, without any document.
"""

from lanternstats.file_queries import FILE_ORACLES
from lanternstats.fixtures import HEALTH_LINES, SERVER_TEXT, oracle_views

_PER_DAY = """per_day AS (SELECT CAST(validafter AS DATE) AS date, count(*) AS count
 FROM (SELECT DISTINCT validafter FROM v_status) GROUP BY 1)"""


def _i(expr):
    return f"CAST({expr} AS BIGINT)"


def _sum(cond):
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def _half_up(numerator, denominator):
    return _i(f"(2 * CAST({numerator} AS HUGEINT) + {denominator}) // (2 * {denominator})")


_FLAGS = ("exit", "guard", "fast", "stable")


def _network_size(source="v_status"):
    return f"""SELECT date, {_i('count(*) // any_value(count)')} AS avg_running,
 {', '.join(_i(f'count(*) FILTER (is{f}) // any_value(count)') + f' AS avg_{f}' for f in _FLAGS)}
FROM (SELECT *, CAST(validafter AS DATE) AS date FROM {source} WHERE isrunning) s JOIN per_day USING (date) GROUP BY date"""


_DIRTY_STATUS = "dirty_status AS (FROM v_status s SEMI JOIN v_updates u ON u.date = CAST(s.validafter AS DATE))"


def _running(source, columns):
    """Running entries of ``source`` with their descriptor's columns and the consensuses of their date."""
    return f"""(SELECT CAST(s.validafter AS DATE) AS date, count, {columns} FROM {source} s
 LEFT JOIN v_descriptor USING (descriptor) JOIN per_day ON per_day.date = CAST(s.validafter AS DATE) WHERE isrunning)"""


def _platforms(source="v_status"):
    names = {"linux": "Linux", "darwin": "Darwin", "bsd": "BSD", "windows": "Windows"}
    found = {n: f"contains(platform, '{w}')" for n, w in names.items()}
    tests = found | {"other": f"NOT ({' OR '.join(found.values())})"}
    cols = ", ".join(_i(f"count(*) FILTER ({t}) // any_value(count)") + f" AS avg_{n}" for n, t in tests.items())
    return f"SELECT date, {cols} FROM {_running(source, 'platform')} r GROUP BY date"


def _relay_day(dirty=False):
    limit = "SEMI JOIN v_updates u ON u.date = CAST(h.intervalend AS DATE)" if dirty else ""
    return f"""relay_day AS (SELECT fingerprint, CAST(intervalend AS DATE) AS date, sum(read) AS read, sum(written) AS written,
 sum(dirread) AS dirread, sum(dirwritten) AS dirwritten
FROM (SELECT DISTINCT fingerprint, intervalend, read, written, dirread, dirwritten FROM v_bwhist h {limit}) GROUP BY ALL)"""


_TOTAL_BWHIST = f"""SELECT date, {_i('r')} AS read, {_i('w')} AS written, {_half_up('dr * (r + w)', '(1 + rw + rr)')} AS dirread,
 {_half_up('dw * (r + w)', '(1 + rw + rr)')} AS dirwritten
FROM (SELECT date, sum(read) AS r, sum(written) AS w, sum(dirread) AS dr, sum(dirwritten) AS dw,
 sum(written) FILTER (dirwritten IS NOT NULL) AS rw, sum(read) FILTER (dirread IS NOT NULL) AS rr FROM relay_day GROUP BY date) t"""


# Each observation once for the date it ends on (back = 0) and once for the date before, with its seconds there.
_PARTS = """parts AS (SELECT lower(CAST(source AS VARCHAR)) AS fingerprint, CAST(CAST(statsend AS DATE) - back AS DATE) AS date, country,
 requests, seconds, CASE back WHEN 0 THEN least(since, seconds) ELSE seconds - since END AS share
FROM (SELECT *, unnest([0, 1]) AS back, epoch(statsend) - epoch(CAST(statsend AS DATE)) AS since FROM v_dirreq) o
WHERE back = 0 OR since < seconds)"""
_SPLIT = f"""SELECT fingerprint, date, country, {_i('sum(piece)')} AS requests
FROM (SELECT DISTINCT fingerprint, date, country, floor(requests * share / seconds) AS piece FROM parts) p GROUP BY ALL"""


def _reporting(dirty=False):
    limit = "SEMI JOIN v_updates u ON u.date = p.date" if dirty else ""
    return f"SELECT DISTINCT fingerprint, p.date AS date, CAST(1 AS BIGINT) AS requests FROM parts p {limit} WHERE country = 'zy'"


_MEASURES = {
    "dw": ("true", "dirwritten"), "dr": ("true", "dirread"), "drw": ("asked", "dirwritten"), "drr": ("asked", "dirread"),
    "bw": ("true", "written"), "br": ("true", "read"), "bwd": ("counts", "written"), "brd": ("counts", "read"),
    "bwr": ("asked", "written"), "brr": ("asked", "read"), "bwdr": ("counts AND asked", "written"),
    "brdr": ("counts AND asked", "read"), "bwp": ("open", "written"), "brp": ("open", "read"),
    "bwn": ("NOT open", "written"), "brn": ("NOT open", "read"),
}
_USER_STATS = f"""SELECT date, country, r, {', '.join(f'b.{n}' for n in _MEASURES)} FROM
 (SELECT date, country, {_i('sum(requests)')} AS r FROM split SEMI JOIN (FROM attributes WHERE mirror) m USING (fingerprint, date)
  GROUP BY ALL) c LEFT JOIN (SELECT date, {', '.join(_i(f'sum({c}) FILTER ({t})') + f' AS {n}' for n, (t, c) in _MEASURES.items())}
 FROM (SELECT h.*, h.dirwritten IS NOT NULL AS counts, q.requests IS NOT NULL AS asked, coalesce(a.open, false) AS open
  FROM relay_day h LEFT JOIN attributes a ON a.fingerprint = CAST(h.fingerprint AS VARCHAR) AND a.date = h.date
  LEFT JOIN reporting q ON q.fingerprint = CAST(h.fingerprint AS VARCHAR) AND q.date = h.date
  WHERE NOT coalesce(a.authority, false)) d GROUP BY date) b USING (date)"""


def _user_stats(dirty):
    source = "dirty_status" if dirty else "v_status"
    attributes = f"""attributes AS (SELECT CAST(fingerprint AS VARCHAR) AS fingerprint, CAST(validafter AS DATE) AS date,
 bool_or(dirport > 0) AS open, bool_or(isauthority) AS authority, bool_or(NOT isauthority) AS mirror FROM {source} GROUP BY ALL)"""
    ctes = [_DIRTY_STATUS] if dirty else []
    ctes += [attributes, _relay_day(dirty), _PARTS, f"split AS ({_SPLIT})", f"reporting AS ({_reporting(dirty)})"]
    return _with(_USER_STATS, *ctes)


_RELAY_COUNTS = f"""relay_counts AS (SELECT validafter, {', '.join(_sum(f'isrunning AND is{f}') + f' AS {f}' for f in ('exit', 'fast', 'guard', 'stable'))},
 {_sum('isrunning')} AS running FROM v_status GROUP BY 1)"""
_RELAY_AVG = "SELECT CAST(validafter AS DATE) AS date, " + ", ".join(
    _i(f"sum({f}) // count(*)") + f" AS {f}" for f in ("exit", "fast", "guard", "running", "stable")
) + " FROM relay_counts GROUP BY 1 HAVING count(*) >= 12"
_BRIDGE_COUNTS = """bridge_counts AS (SELECT time_bucket(INTERVAL 30 MINUTE, seen) AS validafter, count(*) AS brunning
 FROM v_bridge_obs GROUP BY 1)"""


def _bridge_avg(minimum):
    return f"""SELECT CAST(validafter AS DATE) AS date, {_i('sum(brunning) // count(*)')} AS brunning
 FROM bridge_counts GROUP BY 1 HAVING count(*) >= {minimum}"""


_LATEST = """SELECT * FROM (SELECT *, rank() OVER (PARTITION BY bridge, date ORDER BY seen DESC) AS rk FROM v_bridge_obs) x
 WHERE rk = 1"""
_BRIDGE_USERS = f"""SELECT date, country, {_i('sum(users)')} AS users FROM ({_LATEST}) o
WHERE bridge NOT IN (SELECT hashed_relay FROM v_hashed_relays) AND users >= 0
 AND NOT EXISTS (SELECT 1 FROM v_broken b WHERE b.bridge = o.bridge AND b.seen = o.seen) GROUP BY 1, 2"""

_QUARTILES = """SELECT source, date, max(CASE WHEN rn = n // 4 THEN completemillis END) AS q1,
 max(CASE WHEN rn = n // 2 THEN completemillis END) AS md, max(CASE WHEN rn = n * 3 // 4 THEN completemillis END) AS q3
FROM (SELECT source, CAST(started AS DATE) AS date, completemillis,
 row_number() OVER (PARTITION BY source, CAST(started AS DATE) ORDER BY completemillis) AS rn,
 count(*) OVER (PARTITION BY source, CAST(started AS DATE)) AS n FROM v_timing) x WHERE n > 4 GROUP BY 1, 2"""

_TIMING_LOG = """SELECT event_type AS source, make_timestamp((1264982400 + event_id * 300) * 1000000) AS started,
 (event_id % 60) * 1000 + user_id + user_id * 10 // 1000 AS completemillis FROM events
WHERE event_id % 11 <> 0 AND event_id % 7 <> 0 AND event_id % 5 <> 0 AND event_id % 13 <> 0"""

_PACKAGES = """pairs AS (SELECT CAST(DATE '2000-01-01' + CAST(event_id // 2 AS INTEGER) AS DATE) AS date, event_id,
  concat('bundle', CAST(user_id % 4 AS VARCHAR)) AS bundle, event_id AS downloads, user_id FROM events),
 kept AS (SELECT * FROM pairs p WHERE event_id = (SELECT max(event_id) FROM pairs x WHERE x.date = p.date))"""

_UPSERT = """SELECT coalesce(n.source, o.source) AS source, coalesce(n.statsend, o.statsend) AS statsend,
 coalesce(n.seconds, o.seconds) AS seconds, coalesce(n.country, o.country) AS country,
 coalesce(n.requests, o.requests) AS requests,
 CASE WHEN o.source IS NULL THEN 'insert' WHEN n.source IS NULL THEN 'kept'
  WHEN n.requests = o.requests THEN 'unchanged' ELSE 'update' END AS action
FROM (SELECT * FROM v_dirreq WHERE source % 3 <> 0) n FULL JOIN
 (SELECT source, statsend, seconds, country, requests + CASE WHEN source % 4 = 0 THEN 1 ELSE 0 END AS requests
  FROM v_dirreq WHERE source % 2 = 0) o
 ON n.source = o.source AND n.statsend = o.statsend AND n.seconds = o.seconds AND n.country = o.country"""

_MIRROR = """SELECT coalesce(s.descriptor, d.descriptor) AS descriptor, validafter, fingerprint, isrunning, isexit, isguard,
 isfast, isstable, isauthority, dirport, platform, bandwidthavg, bandwidthburst, bandwidthobserved
FROM v_status s FULL JOIN v_descriptor d ON s.descriptor = d.descriptor"""

# Expected rows of the generated documents, straight from the keys.
_K = "SELECT o_orderkey AS k, o_custkey AS cust, CAST(o_orderdate AS DATE) AS day FROM orders"
_ENTRIES = f"""entries AS (SELECT k, day, i FROM ({_K}) o, unnest(generate_series(1, 1 + k % 4)) AS g(i)
 WHERE NOT (k % 13 = 0 AND i >= 2))"""
_VALID_AFTER = "CAST(day AS TIMESTAMP) + to_hours(CAST(k // 3 % 4 * 6 AS INTEGER))"
_ID = "sha1(concat('id', CAST(k AS VARCHAR), '-', CAST(i AS VARCHAR)))"
_DESC = "sha1(concat('d', CAST(k AS VARCHAR), '-', CAST(i AS VARCHAR)))"
_FLAG = {
    "Authority": "(k + i) % 11 = 0", "Exit": "(k + i) % 3 = 0", "Fast": "(k + i) % 2 = 0",
    "Guard": "(k + i) % 5 = 0", "Running": "(k + i) % 4 <> 0", "Stable": "(k + i) % 7 = 0",
}
_RAW = f"""concat('r n', k, 'x', i, ' ', left(base64(unhex({_ID})), 27), ' ', left(base64(unhex({_DESC})), 27), ' ',
 strftime(day, '%Y-%m-%d'), ' 0', i, ':00:00 10.0.', i, '.', k % 256, ' ', 9001 + i, ' ', (k % 2) * 9030, chr(10), 's',
 {', '.join(f"CASE WHEN {c} THEN ' {f}' ELSE '' END" for f, c in _FLAG.items())}, ' Valid', chr(10),
 CASE WHEN (k + i) % 6 <> 0 THEN concat('v Rly 0.2.', (k + i) % 3, '.1', chr(10)) ELSE '' END,
 CASE WHEN (k + i) % 5 <> 0 THEN concat('w Bandwidth=', (k * i) % 1000, CASE WHEN (k + i) % 3 = 1 THEN ' Measured=5' ELSE '' END, chr(10)) ELSE '' END,
 CASE WHEN (k + i) % 3 = 0 THEN concat('p accept 80,443', chr(10)) ELSE '' END)"""
_STATUS_ROWS = f"""SELECT k AS doc_id, {_VALID_AFTER} AS validafter, concat('n', k, 'x', i) AS nickname,
 {_ID} AS fingerprint, {_DESC} AS descriptor, CAST(day AS TIMESTAMP) + to_hours(CAST(i AS INTEGER)) AS published,
 concat('10.0.', i, '.', k % 256) AS address, CAST(9001 + i AS INTEGER) AS orport, CAST((k % 2) * 9030 AS INTEGER) AS dirport,
 {_FLAG['Authority']} AS isauthority, false AS isbadexit, false AS isbaddirectory, {_FLAG['Exit']} AS isexit,
 {_FLAG['Fast']} AS isfast, {_FLAG['Guard']} AS isguard, false AS ishsdir, false AS isnamed, {_FLAG['Stable']} AS isstable,
 {_FLAG['Running']} AS isrunning, false AS isunnamed, true AS isvalid, false AS isv2dir, false AS isv3dir,
 CASE WHEN (k + i) % 6 <> 0 THEN concat('Rly 0.2.', (k + i) % 3, '.1') END AS version,
 CASE WHEN (k + i) % 5 <> 0 THEN (k * i) % 1000 END AS bandwidth,
 CASE WHEN (k + i) % 3 = 0 THEN 'accept 80,443' END AS ports,
 {_RAW} AS rawdesc,
 CAST({_VALID_AFTER} AS DATE) AS date FROM entries WHERE k % 3 <> 1"""

# The signed text of a status document, rebuilt.
_STATUS_SIGNED = f"""SELECT k AS doc_id, upper(sha1(replace(concat('network-status-version 3', chr(10),
 CASE WHEN k % 3 = 1 THEN concat('vote-status vote', chr(10)) ELSE '' END,
 'valid-after ', strftime(any_value(day), '%Y-%m-%d'), ' ', lpad(CAST(k // 3 % 4 * 6 AS VARCHAR), 2, '0'), ':00:00', chr(10),
 CASE WHEN k % 3 = 1 THEN concat('consensus-methods 1 10 ', k % 12, chr(10)) ELSE concat('consensus-method ', k % 12, chr(10)) END,
 {HEALTH_LINES.format(S='VARCHAR')}, 'known-flags Exit Fast Running', chr(10),
 'dir-source a', k % 8, ' FP', (k + 1 - k % 3) % 8, ' 10.0.0.1 80 443', chr(10), 'contact somebody', chr(10),
 CASE WHEN k % 3 <> 1 THEN concat('vote-digest D', k // 8 % 2, chr(10), 'dir-source b', k % 8, ' GP', k % 8,
  ' 10.0.0.2 80 443', chr(10), 'contact nobody', chr(10),
  CASE WHEN k % 2 = 0 THEN concat('vote-digest E', k // 8 % 2, chr(10)) ELSE '' END)
  ELSE concat('fingerprint KP', k % 8, chr(10)) END,
 string_agg(CASE WHEN k % 13 = 0 AND i = 2 THEN concat('r broken x', chr(10), substr({_RAW}, strpos({_RAW}, chr(10)) + 1))
  ELSE {_RAW} END, '' ORDER BY i), 'directory-signature '), chr(10),
 CASE WHEN k % 3 = 1 AND k % 5 = 2 THEN concat(chr(13), chr(10)) ELSE chr(10) END))) AS digest FROM all_entries GROUP BY k"""

_ALL_ENTRIES = f"all_entries AS (SELECT k, day, i FROM ({_K}) o, unnest(generate_series(1, 1 + k % 4)) AS g(i))"
# Counting ends at the broken line.
_FLAG_COUNTS = f"""SELECT k AS doc_id, any_value({_VALID_AFTER}) AS validafter,
 {', '.join(_i(_sum('(' + _FLAG['Running'] + ') AND (' + _FLAG[f] + ')')) + ' AS ' + f.lower() for f in ('Exit', 'Fast', 'Guard', 'Stable'))},
 {_i(_sum(_FLAG['Running']))} AS running FROM entries WHERE k % 3 <> 1 GROUP BY k"""

_C = "SELECT c_custkey AS k FROM customer"
_CUST = f"c AS ({_C})"
_SERVER_SQL = SERVER_TEXT.format(k="k")
_PUBLISHED_TEXT = "concat('2010-02-0', 1 + k % 9, ' 0', k % 10, ':00:00')"

_HISTORY = """history AS (
 SELECT k, 'write-history' AS type, 1 AS line_no, j, k * 10 + j AS value FROM c, unnest(generate_series(1, 1 + k % 5)) AS g(j)
 WHERE k % 17 <> 0 AND k % 11 <> 0 AND NOT (k % 13 = 0 AND k % 5 >= 1 AND j <= 2)
 UNION ALL SELECT k, 'write-history', 2, 1 + k % 5, 7 FROM c WHERE k % 19 = 0 AND k % 17 <> 0 AND NOT stopped
 UNION ALL SELECT k, 'read-history', 3, j, k * 20 + j FROM c, unnest(generate_series(1, 1 + k % 5)) AS g(j)
 WHERE k % 17 <> 0 AND NOT stopped
 UNION ALL SELECT k, 'dirreq-write-history', 4, j, k + j FROM c, unnest(generate_series(1, 1 + k % 5)) AS g(j)
 WHERE k % 17 <> 0 AND k % 3 = 0 AND NOT stopped),
 intervals AS (SELECT *, TIMESTAMP '2010-02-09 12:00:00' - to_seconds(900 * (1 + k % 5 - j)) AS intervalend FROM history)"""
# A bad number ends the document, even in a line that is too old: such a line is dropped without reading its numbers.
_EXTRA_KEYS = "c AS (SELECT c_custkey AS k, c_custkey % 13 = 0 AND c_custkey % 5 >= 1 AND c_custkey % 11 <> 0 AND c_custkey % 17 <> 0 AS stopped FROM customer)"


def _pick(type_):
    return f"arg_max(value, line_no) FILTER (type = '{type_}')"


_BRIDGE_STAMP = "TIMESTAMP '2010-02-01 00:00:00' + to_days(CAST(k % 28 AS INTEGER))"
_BRIDGE = "upper(sha1(unhex(sha1(concat('id', k % m)))))"
# Without a published line the first list already ends the document.
_BRIDGE_LISTS = f"""b AS (SELECT o_orderkey AS k, (SELECT max(c_custkey) FROM customer) AS m FROM orders WHERE o_orderkey % 6 <> 0),
 lists AS (
 SELECT k, m, 'geoip' AS kind, {_BRIDGE_STAMP} + to_hours(12) AS seen, unnest(['de', 'us']) AS country,
  unnest([8 * (1 + k % 5) - 4, 4]) * 86400.0 / (3600 * (12 - k % 10)) AS users FROM b
 UNION ALL
 SELECT k, m, 'ips', {_BRIDGE_STAMP} + to_hours(13), unnest(['fr', 'de']), unnest([8 * (1 + k % 3) - 4, 12]) FROM b WHERE k % 4 = 0),
 bridge_rows AS (SELECT k, m, kind, seen, country, users FROM lists
 UNION ALL SELECT k, m, kind, seen, 'zy', sum(users) FROM lists GROUP BY ALL)"""

_BRIDGE_STATUS = """bs AS (SELECT k, i, (k + i) % n AS m, sha1(unhex(sha1(concat('id', (k + i) % n)))) AS bridge
 FROM (SELECT o_orderkey AS k, (SELECT max(c_custkey) FROM customer) AS n FROM orders) o, unnest(generate_series(1, 1 + k % 4)) AS g(i))"""

# Scrubbed texts built from the keys alone.
_HASHED = "sha1(unhex(sha1(concat('id', k))))"
_GROUPED = " || ' ' || ".join(f"upper(substr({_HASHED}, {1 + 4 * g}, 4))" for g in range(10))
_SCRUBBED_SERVER = f"""concat('router Unnamed 127.0.0.1 9001 7 ', (k % 2) * 9030, chr(10),
 CASE WHEN k % 7 <> 0 THEN concat('platform Rly 0.2.', k % 3, '.19 on Linux', chr(10)) ELSE '' END,
 'published ', {_PUBLISHED_TEXT}, chr(10), 'opt fingerprint ', {_GROUPED}, chr(10),
 CASE WHEN k % 3 <> 0 THEN concat('uptime ', k * 10, chr(10)) ELSE '' END,
 'bandwidth ', k * 3, ' ', k * 4, ' ', k * 2, chr(10),
 CASE WHEN k % 4 <> 0 THEN concat('opt extra-info-digest ', {{digest}}, chr(10)) ELSE '' END,
 'reject *:*', chr(10), 'contact somebody', chr(10),
 'family $', upper(sha1(unhex(sha1(concat('id', k + 1))))), ' Unnamed', chr(10), 'opt hidden-service-dir', chr(10))"""
_SERVER_KEPT = "k % 8 <> 3 AND k % 10 <> 9"
_SCRUBBED_EXTRA = f"""concat('extra-info Unnamed ', upper({_HASHED}), chr(10), 'published ', {_PUBLISHED_TEXT}, chr(10),
 'write-history 2010-02-01 00:00:00 (900 s) ', k, chr(10), 'bridge-ips de=', 8 + k % 8, chr(10))"""
_EXTRA_KEPT = "k % 5 <> 2 AND k % 12 <> 5"
_ZEROS = "repeat('0', 40)"
_LINKED = f"""{_CUST}, linked AS (SELECT k, {_HASHED} AS bridge, {_PUBLISHED_TEXT} AS published,
  CASE WHEN {_EXTRA_KEPT} THEN sha1({_SCRUBBED_EXTRA}) ELSE {_ZEROS} END AS extra_digest,
  {_SERVER_KEPT} AS has_server, {_EXTRA_KEPT} AS has_extra FROM c),
 full_links AS (SELECT *, CASE WHEN has_server THEN
   sha1({_SCRUBBED_SERVER.format(digest='upper(extra_digest)')}) ELSE {_ZEROS} END AS server_digest FROM linked)"""
_NOON = "TIMESTAMP '2010-02-01 12:00:00' + to_days(CAST(s.k % 14 AS INTEGER))"
_STATUS_TEXT = f"""SELECT s.k AS doc_id, string_agg(concat('r Unnamed ', left(base64(unhex(s.bridge)), 27), ' ',
  left(base64(unhex(coalesce(f.server_digest, {_ZEROS}))), 27), ' 2010-02-0', 1 + s.m % 9, ' 0', s.m % 10, ':00:00 127.0.0.1 443 0', chr(10),
  's ', CASE WHEN (s.k + s.i) % 3 = 0 THEN 'Running ' ELSE '' END, 'Valid', chr(10)), '' ORDER BY s.i) AS scrubbed
FROM bs s LEFT JOIN full_links f ON f.k = s.m WHERE s.k % 9 <> 0 GROUP BY s.k"""

_FLAG_MATRIX = """matrix AS (
 SELECT v.relay, v.dir, v.flag, CASE WHEN c.flag IS NOT NULL OR l.relay IS NULL THEN 'agree' ELSE 'lost' END AS state
 FROM (SELECT v.* FROM v_vote_flags v) v
 LEFT JOIN v_consensus_flags c ON v.relay = c.relay AND v.flag = c.flag
 LEFT JOIN (SELECT DISTINCT relay FROM v_consensus_flags) l ON v.relay = l.relay
 UNION ALL
 SELECT w.relay, w.dir, c.flag, 'missing' FROM (SELECT DISTINCT relay, dir FROM v_vote_flags) w
 JOIN v_consensus_flags c ON w.relay = c.relay JOIN v_known_flags k ON k.dir = w.dir AND k.flag = c.flag
 WHERE NOT EXISTS (SELECT 1 FROM v_vote_flags v WHERE v.relay = w.relay AND v.dir = w.dir AND v.flag = c.flag))"""


def _state(name):
    count = f"sum(CASE WHEN state = '{name}' THEN 1 ELSE 0 END)"
    return _i(f"CASE WHEN {count} > 0 THEN {count} END") + f" AS {name}"


# Votes and, per time, the consensus with the smallest key.
_VOTES = f"""heads AS (SELECT {_VALID_AFTER} AS validafter, k, concat('a', k % 8) AS dir, k % 3 = 1 AS is_vote,
 CASE WHEN k % 4 <> 0 THEN concat('0.2.', k % 3) END AS client, CASE WHEN k % 5 <> 0 THEN concat('0.2.', k % 2) END AS server,
 k % 6 <> 0 AS has_params, k % 7 = 0 AS bogus, CASE WHEN k % 4 = 1 THEN 10 ELSE k % 2 END AS circ FROM ({_K}) o),
 votes AS (SELECT * FROM heads WHERE is_vote),
 cons AS (SELECT validafter, min(k) AS c FROM heads WHERE NOT is_vote GROUP BY 1),
 pairs AS (SELECT v.k AS k, v.dir AS dir, v.validafter AS validafter, v.client, v.server, v.has_params, v.bogus, v.circ, h.circ AS c_circ, h.k AS c, h.client AS c_client, h.server AS c_server,
  h.has_params AS c_has_params, h.bogus AS c_bogus FROM votes v JOIN cons USING (validafter) JOIN heads h ON h.k = cons.c)"""

_AUTHORITIES = ("dannenberg", "dizum", "gabelmoo", "ides", "maatuska", "moria1", "tor26", "urras")
_KNOWN = "['Exit', 'Fast', 'Running']"
_FLAGS_OF = f"""list_filter([{', '.join(f"CASE WHEN {c} THEN '{f}' END" for f, c in _FLAG.items())}, 'Valid'], lambda x: x IS NOT NULL)"""
# Comparisons of the latest time with a vote and a consensus; no relay of the test documents is in two of them.
_HEALTH_REPORT = f"""SELECT x.* FROM (SELECT max(validafter) AS t FROM votes JOIN cons USING (validafter)) n, LATERAL (
 WITH v AS (SELECT * FROM votes WHERE validafter = t), p AS (SELECT * FROM pairs WHERE validafter = t),
  listed AS (SELECT dir, k, i FROM v JOIN entries USING (k) UNION ALL SELECT 'consensus', k, i FROM cons JOIN entries ON k = c WHERE validafter = t),
  flags AS (SELECT dir, upper({_ID}) AS relay, unnest({_FLAGS_OF}) AS flag FROM listed WHERE dir <> 'consensus')
 SELECT 'known_flags' AS "table", dir AS key, concat(unnest({_KNOWN}), '|', t) AS value FROM (SELECT dir FROM v UNION ALL SELECT 'consensus') d
 UNION ALL SELECT 'relay_counts', dir, concat({_i(_sum(_FLAG['Running']))}, '|', count(*)) FROM listed GROUP BY dir
 UNION ALL SELECT 'method_support', dir, concat_ws('|', concat('1 10 ', k % 12), contains(concat('1 10 ', k % 12), CAST(c % 12 AS VARCHAR)), c % 12 IN (1, 10, k % 12)) FROM p
 UNION ALL SELECT 'version_agreement', dir, concat(coalesce(CAST(CASE WHEN client IS NOT NULL THEN client IS NOT DISTINCT FROM c_client END AS VARCHAR), '-'), '|',
   coalesce(CAST(CASE WHEN server IS NOT NULL THEN server IS NOT DISTINCT FROM c_server END AS VARCHAR), '-')) FROM p
 UNION ALL SELECT 'parameter_conflicts', dir, concat(has_params AND (bogus OR NOT c_has_params OR NOT (circ = c_circ OR circ = 1 AND c_circ = 10)), '|',
   has_params AND (bogus OR NOT c_has_params OR circ <> c_circ), '|', CASE WHEN has_params THEN concat('circwindow=', circ, CASE WHEN bogus THEN ' bogus=1' ELSE '' END) ELSE '-' END) FROM p
 UNION ALL SELECT 'expiring_keys', dir, concat(1 + k % 28 < 3, '|', TIMESTAMP '2024-02-01' + to_days(CAST(k % 28 AS INTEGER))) FROM v WHERE k % 9 <> 0
 UNION ALL SELECT 'bandwidth_scanners', dir, CAST(count(*) AS VARCHAR) FROM listed WHERE dir <> 'consensus' AND (k + i) % 5 <> 0 AND (k + i) % 3 = 1 GROUP BY dir
 UNION ALL SELECT 'authority_versions', upper({_ID}), concat('n', k, 'x', i, '|Rly 0.2.', (k + i) % 3, '.1') FROM listed
  WHERE dir = 'consensus' AND (k + i) % 11 = 0 AND (k + i) % 6 <> 0
 UNION ALL SELECT 'missing_votes', unnest([{', '.join(f"'{a}'" for a in _AUTHORITIES)}]), ''
 UNION ALL SELECT 'consensus_age', '', concat(t < TIMESTAMP '2024-01-19 21:00:00', '|', t)
 UNION ALL SELECT 'flag_matrix', concat(relay, ' ', dir), concat(flag, '|agree') FROM flags
 UNION ALL SELECT 'flag_overlap', d.dir, concat(coalesce(CAST(nullif(count(f.flag), 0) AS VARCHAR), '-'), '|', d.flag, '|-|-')
  FROM (SELECT DISTINCT dir, unnest({_KNOWN}) AS flag FROM v) d LEFT JOIN flags f ON f.dir = d.dir AND f.flag = d.flag GROUP BY d.dir, d.flag) x"""

_RANGES_BY_VERSION = """versions AS (SELECT DISTINCT version FROM v_ip_ranges),
 asked AS (SELECT req_id, ip, day, coalesce((SELECT max(version) FROM versions WHERE version <= day),
  (SELECT min(version) FROM versions)) AS version FROM v_ips)"""
_IP_COUNTRY = """SELECT a.req_id, a.version, coalesce(r.country, 'ZZ') AS country FROM asked a LEFT JOIN v_ip_ranges r
 ON a.version = r.version AND a.ip BETWEEN r.from_ip AND r.to_ip"""

_SEGMENTS = """borders AS (SELECT from_ip AS b FROM v_ip_ranges UNION SELECT to_ip + 1 FROM v_ip_ranges),
 segments AS (SELECT b AS from_ip, lead(b) OVER (ORDER BY b) - 1 AS to_ip FROM borders)"""

_COMPLETENESS = """SELECT published, {found_s} AS found_servers, {all_s} AS all_servers,
 CASE WHEN {all_s} > 0 THEN round(100.0 * {found_s} / {all_s}, 1) END AS servers_pct,
 {found_e} AS found_extras, {all_e} AS all_extras,
 CASE WHEN {all_e} > 0 THEN round(100.0 * {found_e} / {all_e}, 1) END AS extras_pct
FROM v_refs r LEFT JOIN v_have s ON r.doc_id = s.doc_id
LEFT JOIN (SELECT doc_id FROM v_have WHERE doc_id % 3 <> 0) e ON e.doc_id = CASE WHEN s.doc_id % 2 = 0 THEN s.doc_id + 1 END
GROUP BY 1""".format(
    found_s="count(s.doc_id)", all_s="count(*)", found_e="count(e.doc_id)",
    all_e="count(CASE WHEN s.doc_id % 2 = 0 THEN 1 END)",
)

_REPLACED = """stored AS ({stored}), fresh AS ({fresh})
SELECT * FROM stored WHERE date NOT IN (SELECT date FROM v_updates) UNION ALL SELECT * FROM fresh"""


def _with(query, *ctes):
    """Put the given CTEs, and the fixture views they and the query use, before a query."""
    body = " ".join(ctes) + query
    parts = oracle_views(body) + list(ctes)
    return (f"WITH {', '.join(parts)} " if parts else "") + query


def _with_tail(text, *ctes):
    """Like ``_with`` for a text that starts with further CTEs."""
    body = " ".join(ctes) + text
    return f"WITH {', '.join(oracle_views(body) + list(ctes))}, {text}"


_STALE_SIZES = "SELECT date, avg_running + 1000 AS avg_running, " + ", ".join(
    f"avg_{f} + 1000 AS avg_{f}" for f in _FLAGS
) + f" FROM ({_network_size()}) z"
_HALF_STATUS = "half AS (SELECT * FROM dirty_status WHERE day(validafter) % 2 = 0)"

_OVERLAY = _with(
    "SELECT s.from_ip AS from_ip, s.to_ip AS to_ip, " + ", ".join(
        f"coalesce(max(CASE WHEN r.version = '{v}' THEN r.country END), 'ZZ') AS v{v}"
        for v in ("20100101", "20100102", "20100103")
    ) + " FROM segments s JOIN v_ip_ranges r ON s.from_ip BETWEEN r.from_ip AND r.to_ip GROUP BY 1, 2",
    _SEGMENTS,
)
ORACLES = {
    "relay_statuses_per_day": _with("SELECT * FROM per_day", _PER_DAY),
    "network_size": _with(_network_size(), _PER_DAY),
    "network_size_hour": _with(
        f"SELECT validafter, count(*) AS avg_running, {', '.join(_i(_sum('is' + f)) + f' AS avg_{f}' for f in _FLAGS)}"
        " FROM v_status WHERE isrunning GROUP BY 1"
    ),
    "relay_platforms": _with(_platforms(), _PER_DAY),
    "relay_versions": _with(
        f"""SELECT date, version, {_i('count(*) // any_value(count)')} AS relays
FROM {_running('v_status', 'substring(platform, 5, 5) AS version')} r WHERE version IS NOT NULL GROUP BY ALL""", _PER_DAY,
    ),
    "total_bandwidth": _with(
        "SELECT date, " + ", ".join(
            _half_up(f"sum({e})", "any_value(count)") + f" AS {n}" for n, e in {
                "bwavg": "bandwidthavg", "bwburst": "bandwidthburst", "bwobserved": "bandwidthobserved",
                "bwadvertised": "least(bandwidthavg, bandwidthobserved)",
            }.items()
        ) + f" FROM {_running('v_status', 'bandwidthavg, bandwidthburst, bandwidthobserved')} r GROUP BY date", _PER_DAY,
    ),
    "total_bwhist": _with(_TOTAL_BWHIST, _relay_day()),
    "dirreq_split": _with(_SPLIT, _PARTS),
    "relay_attributes": _with(
        f"""SELECT CAST(fingerprint AS VARCHAR) AS fingerprint, CAST(validafter AS DATE) AS date,
 {_i('sum(CASE WHEN dirport > 0 THEN 1 END)')} AS opendirport, {_i('sum(CASE WHEN isauthority THEN 1 END)')} AS authority,
 bool_or(NOT isauthority) AS ismirror FROM v_status GROUP BY 1, 2"""
    ),
    "reporting_relays": _with(_reporting(), _PARTS),
    "user_stats": _user_stats(False),
    "tutorial_running_exit": _with(
        f"""SELECT CAST(validafter AS DATE) AS date, {_i('sum(listed) // count(*)')} AS avg_running, {_i('sum(exits) // count(*)')} AS avg_exit
FROM (SELECT validafter, count(*) AS listed, count(*) FILTER (isexit) AS exits FROM v_status GROUP BY validafter) c GROUP BY 1 ORDER BY 1"""
    ),
    "tutorial_versions": _with(
        f"""SELECT date, version, {_i('count(*) // any_value(count)')} AS count
FROM (SELECT CAST(validafter AS DATE) AS date, (SELECT max(substring(platform, 5, 5)) FROM v_descriptor d WHERE d.descriptor = s.descriptor) AS version
 FROM v_status s) l JOIN per_day USING (date) GROUP BY date, version ORDER BY date, version NULLS LAST""", _PER_DAY,
    ),
    "network_size_dirty": _with(_network_size("dirty_status"), _PER_DAY, _DIRTY_STATUS),
    "relay_platforms_dirty": _with(_platforms("dirty_status"), _PER_DAY, _DIRTY_STATUS),
    "total_bwhist_dirty": _with(_TOTAL_BWHIST, _relay_day(True)),
    "user_stats_dirty": _user_stats(True),
    "partial_refresh": _with_tail(
        _REPLACED.format(stored=_STALE_SIZES, fresh=_network_size("dirty_status")), _PER_DAY, _DIRTY_STATUS
    ),
    "refresh_vanished": _with_tail(
        _REPLACED.format(stored=_network_size(), fresh=_network_size("half")), _PER_DAY, _DIRTY_STATUS, _HALF_STATUS
    ),
    "consensus_daily_avg": _with(_RELAY_AVG, _RELAY_COUNTS),
    "bridge_daily_avg": _with(_bridge_avg(24), _BRIDGE_COUNTS),
    "daily_relays_bridges_spine": _with(
        """SELECT s.date AS date, exit, fast, guard, running, stable, brunning FROM spine s
LEFT JOIN r ON r.date = s.date LEFT JOIN b ON b.date = s.date""",
        _RELAY_COUNTS, _BRIDGE_COUNTS, f"r AS ({_RELAY_AVG})", f"b AS ({_bridge_avg(47)})",
        """spine AS (SELECT CAST(unnest(generate_series((SELECT least((SELECT min(date) FROM r), (SELECT min(date) FROM b))),
 (SELECT greatest((SELECT max(date) FROM r), (SELECT max(date) FROM b))), INTERVAL 1 DAY)) AS DATE) AS date)""",
    ),
    "bridge_latest": _with(f"SELECT bridge, date, seen, country, users FROM ({_LATEST}) x"),
    "bridge_users": _with(_BRIDGE_USERS),
    "bridge_stats_rows": _with(f"SELECT * FROM ({_BRIDGE_USERS}) x WHERE users >= 1"),
    "timing_log": _TIMING_LOG,
    "timing_quartiles": _with(_QUARTILES),
    "timing_stats_batches": _with(_QUARTILES),
    "package_stats_batches": _with("SELECT date, bundle, downloads FROM v_packages"),
    "bridge_history": _with(_BRIDGE_USERS),
    "last_observation": _with("SELECT source, max(started) AS last_seen FROM v_timing GROUP BY 1"),
    "package_log": _with(
        "SELECT date, bundle, downloads FROM kept UNION ALL SELECT date, 'other', user_id FROM kept", _PACKAGES
    ),
    "package_wide": _with(
        "SELECT CAST(date AS VARCHAR) AS date, " + ", ".join(
            f"coalesce(CAST(max(CASE WHEN bundle = '{b}' THEN downloads END) AS VARCHAR), 'NA') AS \"{b}\""
            for b in ("click", "error", "purchase", "signup", "view")
        ) + " FROM v_packages GROUP BY v_packages.date"
    ),
    "insert_if_absent": _with("SELECT * FROM v_status WHERE fingerprint % 2 = 0 AND fingerprint % 6 <> 0"),
    "upsert_rows": _with(_UPSERT),
    "upsert_actions": _with(f"SELECT action, count(*) AS n FROM ({_UPSERT}) x GROUP BY 1"),
    "changed_values": _with(
        """SELECT bridge, date, max(CASE WHEN rn = 1 THEN users END) AS users, min(users) <> max(users) AS changed
FROM (SELECT *, row_number() OVER (PARTITION BY bridge, date ORDER BY seen DESC, country DESC) AS rn FROM v_bridge_obs) x GROUP BY 1, 2"""
    ),
    "dirty_dates": _with(
        """SELECT CAST(validafter AS DATE) AS date FROM v_status UNION SELECT CAST(o_orderdate AS DATE) FROM orders
UNION SELECT CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) FROM orders UNION SELECT CAST(intervalend AS DATE) FROM v_bwhist"""
    ),
    "denormalised_mirror": _with(_MIRROR),
    "mirror_refresh": _with(_MIRROR),
    "mirror_batches": _with(_MIRROR),
    "split_documents": f"""SELECT doc_id, CAST(n AS BIGINT) AS doc_no, octet_length(encode(t)) AS bytes, sha1(t) AS digest FROM (
 SELECT doc_id, unnest(generate_series(0, doc_id % 3)) AS n, concat('router ', text, chr(10), 'router-signature', chr(10),
 '-----BEGIN SIGNATURE-----', chr(10), 'c2ln', chr(10), '-----END SIGNATURE-----', chr(10)) AS t FROM documents) x""",
    "document_digest": """SELECT doc_id, sha1(concat('router ', text, chr(10), 'router-signature', chr(10))) AS digest FROM documents""",
    "classify_documents": """SELECT 'status' AS doc_type, count(*) AS documents FROM orders UNION ALL
SELECT 'server', count(*) FROM customer UNION ALL SELECT 'extra', count(*) FROM customer""",
    "status_headers": _with(
        f"""SELECT k AS doc_id, k % 3 <> 1 AS is_consensus, {_VALID_AFTER} AS validafter,
 CASE WHEN k % 3 = 1 THEN concat('a', k % 8) ELSE concat('b', k % 8) END AS dirname,
 CASE WHEN k % 3 = 1 THEN concat('FP', (k + 1 - k % 3) % 8) ELSE concat('GP', k % 8) END AS dirsource,
 CASE WHEN k % 3 = 1 THEN concat('KP', k % 8) END AS fingerprint,
 CASE WHEN k % 3 = 1 THEN '' ELSE concat('FP', (k + 1 - k % 3) % 8, CASE WHEN k % 2 = 0 THEN concat(',GP', k % 8) ELSE '' END) END AS vote_sources,
 CASE WHEN k % 3 = 1 THEN '' ELSE concat('FP', (k + 1 - k % 3) % 8, ' D', k // 8 % 2, CASE WHEN k % 2 = 0 THEN concat(',GP', k % 8, ' E', k // 8 % 2) ELSE '' END) END AS vote_references
FROM ({_K}) o"""
    ),
    "stale_consensus": _with(
        f"SELECT k AS doc_id, {_VALID_AFTER} AS valid_after, {_VALID_AFTER} < TIMESTAMP '1996-12-31 18:00:00' AS is_stale FROM ({_K}) o"
    ),
    "references_seen": _with(
        f"""SELECT 'vote' AS type, {_VALID_AFTER} AS published, concat('FP', (k + 1 - k % 3) % 8) AS relay, CAST(NULL AS VARCHAR) AS digest
 FROM ({_K}) o WHERE k % 3 <> 1
UNION ALL SELECT 'vote', {_VALID_AFTER}, concat('GP', k % 8), NULL FROM ({_K}) o WHERE k % 3 <> 1 AND k % 2 = 0
UNION ALL SELECT 'server', CAST(day AS TIMESTAMP) + to_hours(CAST(i AS INTEGER)), {_ID}, {_DESC} FROM entries
UNION ALL SELECT 'extra', CAST({_PUBLISHED_TEXT} AS TIMESTAMP), sha1(concat('id', k)), sha1(concat('x', k)) FROM c
 WHERE k % 10 <> 9 AND k % 4 <> 0""", _ENTRIES, _CUST
    ),
    "parse_status_entries": _with(_STATUS_ROWS, _ENTRIES),
    "flag_counts": _with(_FLAG_COUNTS, _ENTRIES),
    "identity_hash": _with(f"SELECT DISTINCT upper(sha1(unhex({_ID}))) AS hashed_relay FROM entries WHERE k % 3 <> 1", _ENTRIES),
    "vote_digest": _with(_STATUS_SIGNED, _ALL_ENTRIES),
    "parse_server_descriptors": _with(
        f"""SELECT k AS doc_id, sha1(concat({_SERVER_SQL}, 'router-signature', chr(10))) AS descriptor, concat('nick', k) AS nickname,
 concat('10.1.', k % 250, '.', k % 100) AS address, CAST(9001 AS INTEGER) AS orport, CAST((k % 2) * 9030 AS INTEGER) AS dirport,
 sha1(concat('id', k)) AS fingerprint, k * 3 AS bandwidthavg, k * 4 AS bandwidthburst, k * 2 AS bandwidthobserved,
 CASE WHEN k % 7 <> 0 THEN concat('Rly 0.2.', k % 3, '.19 on Linux') END AS platform,
 CAST({_PUBLISHED_TEXT} AS TIMESTAMP) AS published, CASE WHEN k % 3 <> 0 THEN k * 10 END AS uptime,
 CASE WHEN k % 4 <> 0 THEN sha1(concat('x', k)) END AS extrainfo FROM c WHERE k % 10 <> 9""", _CUST,
    ),
    "parse_extra_infos": _with(
        """SELECT k AS doc_id, concat('nick', k) AS nickname, sha1(concat('id', k)) AS fingerprint,
 CAST(concat('2010-02-10 0', k % 10, ':00:00') AS TIMESTAMP) AS published FROM c""", _CUST,
    ),
    "history_explode": _with("SELECT k AS doc_id, type, intervalend, value FROM intervals", _EXTRA_KEYS, _HISTORY),
    "history_pivot": _with(
        f"""SELECT k AS doc_id, sha1(concat('id', k)) AS fingerprint, intervalend, {_pick('read-history')} AS read,
 {_pick('write-history')} AS written, {_pick('dirreq-read-history')} AS dirread, {_pick('dirreq-write-history')} AS dirwritten
FROM intervals GROUP BY k, intervalend""", _EXTRA_KEYS, _HISTORY,
    ),
    "dirreq_observations": _with(
        """SELECT k AS doc_id, upper(sha1(concat('id', k))) AS source, CAST(concat('2010-02-09 0', k % 10, ':30:00') AS TIMESTAMP) AS statsend,
 CAST(86400 AS BIGINT) AS seconds, unnest(['de', 'us', 'fr', 'zy']) AS country,
 unnest([4 + k % 50, 12 + k % 9, 4, 20 + k % 50 + k % 9]) AS requests FROM c WHERE k % 7 > 1 AND NOT stopped""", _EXTRA_KEYS,
    ),
    "bridge_users_geoip": _with(
        f"SELECT k AS doc_id, {_BRIDGE} AS bridge, seen, kind, country, round(CAST(users AS DOUBLE), 2) AS users FROM bridge_rows", _BRIDGE_LISTS
    ),
    "bridge_unknown_only": _with(
        """SELECT CAST(seen AS DATE) AS date, kind, country, round(sum(round(CAST(users AS DOUBLE), 2)), 2) AS users FROM bridge_rows
WHERE k % m NOT IN (SELECT hashed_relay FROM v_hashed_relays) GROUP BY ALL""", _BRIDGE_LISTS
    ),
    "bridge_running": """SELECT k AS doc_id, count(CASE WHEN (k + i) % 3 = 0 THEN 1 END) AS running
FROM (SELECT o_orderkey AS k FROM orders) o, unnest(generate_series(1, 1 + k % 4)) AS g(i) GROUP BY k""",
    "broken_versions": _with(
        f"SELECT DISTINCT upper({_HASHED}) AS bridge, CAST({_PUBLISHED_TEXT} AS TIMESTAMP) AS seen FROM c WHERE k % 7 <> 0 AND k % 3 = 2", _CUST
    ),
    "flag_matrix": _with("SELECT * FROM matrix", _FLAG_MATRIX),
    "flag_overlap": _with(
        f"""SELECT k.dir AS dir, k.flag AS flag, {_state('lost')}, {_state('agree')}, {_state('missing')}
FROM v_known_flags k LEFT JOIN matrix m ON k.dir = m.dir AND k.flag = m.flag GROUP BY 1, 2""", _FLAG_MATRIX
    ),
    "known_flags": _with(
        """SELECT validafter, dir, unnest(['Exit', 'Fast', 'Running']) AS flag FROM votes
UNION ALL SELECT validafter, 'consensus', unnest(['Exit', 'Fast', 'Running']) FROM cons""", _VOTES
    ),
    "missing_votes": _with(
        """SELECT DISTINCT concat('auth', CAST(s_suppkey % 8 AS VARCHAR)) AS dir FROM supplier
WHERE concat('auth', CAST(s_suppkey % 8 AS VARCHAR)) NOT IN (SELECT dir FROM v_vote_flags WHERE dir <> 'auth7')"""
    ),
    "vote_relay_counts": _with(
        f"""SELECT validafter, dir, count(*) AS total, {_i(_sum(_FLAG['Running']))} AS running FROM (
 SELECT validafter, dir, k, i FROM votes JOIN entries USING (k)
 UNION ALL SELECT validafter, 'consensus', k, i FROM cons JOIN entries ON k = c) x GROUP BY 1, 2""", _ENTRIES, _VOTES
    ),
    "health_report": _with(_HEALTH_REPORT, _ENTRIES, _VOTES),
    "bandwidth_scanners": _with(
        f"""SELECT k AS dir, {_i(_sum('(k + i) % 5 <> 0 AND (k + i) % 3 = 1'))} AS measured FROM entries WHERE k % 3 = 1
GROUP BY k HAVING sum(CASE WHEN (k + i) % 5 <> 0 AND (k + i) % 3 = 1 THEN 1 ELSE 0 END) > 0""", _ENTRIES
    ),
    "authority_versions": _with(
        f"""SELECT upper({_ID}) AS relay, concat('n', k, 'x', i) AS nickname, concat('Rly 0.2.', (k + i) % 3, '.1') AS version
FROM entries WHERE k % 3 <> 1 AND (k + i) % 11 = 0 AND (k + i) % 6 <> 0""", _ENTRIES
    ),
    "method_support": _with(
        """SELECT dir, concat('1 10 ', k % 12) AS consensus_methods, contains(concat('1 10 ', k % 12), CAST(c % 12 AS VARCHAR)) AS supported,
 c % 12 IN (1, 10, k % 12) AS supported_exactly FROM pairs""", _VOTES
    ),
    "version_agreement": _with(
        """SELECT dir, CASE WHEN client IS NOT NULL THEN client IS NOT DISTINCT FROM c_client END AS client_agrees,
 CASE WHEN server IS NOT NULL THEN server IS NOT DISTINCT FROM c_server END AS server_agrees FROM pairs""", _VOTES
    ),
    "params_conflicts": _with(
        """SELECT dir, has_params AND (bogus OR NOT c_has_params OR NOT (circ = c_circ OR circ = 1 AND c_circ = 10)) AS conflicting,
 has_params AND (bogus OR NOT c_has_params OR circ <> c_circ) AS conflicting_exactly FROM pairs""", _VOTES
    ),
    "expiring_keys": _with(
        """SELECT dir, TIMESTAMP '2024-02-01' + to_days(CAST(k % 28 AS INTEGER)) AS key_expires, 1 + k % 28 < 3 AS expires_soon
FROM votes WHERE k % 9 <> 0""", _VOTES
    ),
    "latest_votes": _with(
        "SELECT validafter, dir FROM votes WHERE validafter = (SELECT max(validafter) FROM heads)", _VOTES
    ),
    "flag_overlap_documents": _with(
        f"""SELECT d.dir AS dir, f.flag AS flag, {_state('lost')}, {_state('agree')}, {_state('missing')}
FROM (SELECT DISTINCT dir FROM voted) d CROSS JOIN (SELECT unnest(['Exit', 'Fast', 'Running']) AS flag) f
LEFT JOIN states s ON s.dir = d.dir AND s.flag = f.flag GROUP BY 1, 2""", _ENTRIES,
        f"""flagged AS (SELECT k, i, k % 3 = 1 AS is_vote, concat('a', k % 8) AS dir, list_filter([{', '.join(f"CASE WHEN {c} THEN '{f}' END" for f, c in _FLAG.items())}, 'Valid'], lambda x: x IS NOT NULL) AS flags FROM entries)""",
        """voted AS (SELECT i AS relay, dir, list_distinct(flatten(list(flags))) AS flags FROM flagged WHERE is_vote GROUP BY 1, 2)""",
        """listed AS (SELECT i AS relay, list_distinct(flatten(list(flags))) AS flags FROM flagged WHERE NOT is_vote GROUP BY 1)""",
        """states AS (SELECT v.dir AS dir, unnest(v.flags) AS flag, 'agree' AS state FROM voted v WHERE v.relay NOT IN (SELECT relay FROM listed)
 UNION ALL SELECT v.dir, unnest(list_intersect(v.flags, l.flags)), 'agree' FROM voted v JOIN listed l USING (relay)
 UNION ALL SELECT v.dir, unnest(list_filter(v.flags, lambda x: NOT list_contains(l.flags, x))), 'lost' FROM voted v JOIN listed l USING (relay)
 UNION ALL SELECT v.dir, unnest(list_filter(l.flags, lambda x: NOT list_contains(v.flags, x) AND x IN ('Exit', 'Fast', 'Running'))), 'missing' FROM voted v JOIN listed l USING (relay))""",
    ),
    "archive_report": _with(
        """SELECT kind, x.validafter AS validafter, x.dirsource AS dirsource, count(s.d) AS found_servers, count(*) AS all_servers, round(100.0 * count(s.d) / count(*), 1) AS servers_pct,
 count(*) FILTER (s.has_extra AND s.extra_found) AS found_extras, count(*) FILTER (s.has_extra) AS all_extras,
 CASE WHEN count(*) FILTER (s.has_extra) > 0 THEN round(100.0 * count(*) FILTER (s.has_extra AND s.extra_found) / count(*) FILTER (s.has_extra), 1) END AS extras_pct,
 any_value(v.found_votes) AS found_votes, any_value(v.all_votes) AS all_votes, any_value(round(100.0 * v.found_votes / v.all_votes, 1)) AS votes_pct
FROM (SELECT 'C' AS kind, r.validafter AS validafter, CAST(NULL AS VARCHAR) AS dirsource, k, i FROM refs r JOIN newest USING (validafter) WHERE NOT is_vote
 UNION ALL SELECT 'V', r.validafter, source, k, i FROM refs r JOIN named n ON n.validafter = r.validafter AND n.dirsource = r.source AND n.digest = r.digest WHERE is_vote) x
LEFT JOIN have s ON s.d = x.k * 8 + x.i
LEFT JOIN (SELECT n.validafter, count(DISTINCT n.dirsource || n.digest) AS all_votes, count(DISTINCT h.source || h.digest) AS found_votes FROM named n
 LEFT JOIN refs h ON h.is_vote AND h.validafter = n.validafter AND h.source = n.dirsource AND h.digest = n.digest GROUP BY 1) v ON x.kind = 'C' AND v.validafter = x.validafter
GROUP BY 1, 2, 3""", _ENTRIES,
        f"""refs AS (SELECT k, i, k % 3 = 1 AS is_vote, {_VALID_AFTER} AS validafter, concat(CASE WHEN k % 3 = 1 THEN 'FP' ELSE 'GP' END, k % 8) AS source, concat('D', k // 8 % 2) AS digest FROM entries)""",
        """newest AS (SELECT DISTINCT validafter FROM refs WHERE NOT is_vote ORDER BY 1 DESC LIMIT 400)""",
        """named AS (SELECT DISTINCT validafter, dirsource, n.digest AS digest FROM (SELECT validafter, concat('FP', (k + 1 - k % 3) % 8) AS dirsource, digest FROM refs WHERE NOT is_vote
 UNION ALL SELECT validafter, concat('GP', k % 8), concat('E', k // 8 % 2) FROM refs WHERE NOT is_vote AND k % 2 = 0) n JOIN newest USING (validafter))""",
        """have AS (SELECT k * 8 + i AS d, k % 2 = 0 AS has_extra, k % 4 = 0 AS extra_found FROM entries WHERE k % 5 <> 0)""",
    ),
    "consensus_age": _with(
        "SELECT max(validafter) AS validafter, max(validafter) < TIMESTAMP '2024-01-19 21:00:00' AS is_stale FROM v_status"
    ),
    "stale_status": _with(
        "SELECT max(validafter) AS latest, max(validafter) < TIMESTAMP '2024-02-01 18:00:00' AS is_stale FROM v_status"
    ),
    "archive_completeness": _with(_COMPLETENESS),
    "last_three_documents": _with(
        "SELECT published, ref_id, doc_id FROM v_refs WHERE published IN (SELECT DISTINCT published FROM v_refs ORDER BY 1 DESC LIMIT 3)"
    ),
    "vote_completeness": _with(
        """SELECT r.published AS published, count(h.doc_id) AS found_votes, count(*) AS all_votes,
 round(100.0 * count(h.doc_id) / count(*), 1) AS votes_pct FROM (SELECT DISTINCT published, doc_id FROM v_refs) r
LEFT JOIN v_have h ON r.doc_id = h.doc_id GROUP BY 1"""
    ),
    "missing_references": _with(
        """SELECT DISTINCT published, doc_id FROM v_refs WHERE published >= DATE '1998-01-01'
 AND doc_id NOT IN (SELECT doc_id FROM v_have)"""
    ),
    "missing_counts": _with(
        """SELECT 'server' AS type, count(*) AS missing FROM (SELECT DISTINCT published, doc_id FROM v_refs
 WHERE published >= DATE '1998-01-01' AND doc_id NOT IN (SELECT doc_id FROM v_have)) x"""
    ),
    "ip_country": _with(_IP_COUNTRY, _RANGES_BY_VERSION),
    "ip_country_shuffled": _with(_IP_COUNTRY, _RANGES_BY_VERSION),
    "ip_country_gaps": _with(
        """SELECT a.req_id, a.version, coalesce((SELECT max(r.country) FROM v_ip_ranges r WHERE r.version = a.version
  AND s.from_ip BETWEEN r.from_ip AND r.to_ip), 'ZZ') AS country
FROM asked a ASOF LEFT JOIN (FROM segments g SEMI JOIN v_ip_ranges r ON g.from_ip BETWEEN r.from_ip AND r.to_ip) s ON a.ip >= s.from_ip""",
        _RANGES_BY_VERSION, _SEGMENTS
    ),
    "db_version_asof": _with(
        """SELECT req_id, version AS version_now, coalesce((SELECT max(version) FROM versions
  WHERE version <= strftime(strptime(day, '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d')), (SELECT min(version) FROM versions)) AS version_week
FROM asked""", _RANGES_BY_VERSION
    ),
    "ip_overlay": _OVERLAY,
    "stored_overlay": _OVERLAY,
    "ip_country_stored": _with(_IP_COUNTRY, _RANGES_BY_VERSION),
    "statuses_to_rewrite": """SELECT DISTINCT date_trunc('hour', ts) AS validafter, event_id AS status FROM events e
WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT TIMESTAMP '2024-01-01' + to_days(CAST(o_custkey % 20 * 3 AS INTEGER))
  + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS published FROM orders) p
 WHERE date_trunc('hour', e.ts) >= p.published AND date_trunc('hour', e.ts) <= p.published + INTERVAL 24 HOUR)""",
    "scrub_servers": _with(
        f"SELECT k AS doc_id, {_HASHED} AS bridge, {_PUBLISHED_TEXT} AS published, {_SCRUBBED_SERVER.format(digest=_ZEROS)} AS scrubbed"
        f" FROM c WHERE {_SERVER_KEPT}", _CUST
    ),
    "scrub_extras": _with(
        f"""SELECT k AS doc_id, {_HASHED} AS bridge, {_PUBLISHED_TEXT} AS published, {_SCRUBBED_EXTRA} AS scrubbed,
 sha1({_SCRUBBED_EXTRA}) AS extra_digest FROM c WHERE {_EXTRA_KEPT}""", _CUST
    ),
    "relink_servers": _with("SELECT k AS doc_id, bridge, published, extra_digest, server_digest FROM full_links WHERE has_server", _LINKED),
    "reference_mapping": _with(
        "SELECT bridge, published, server_digest, extra_digest FROM full_links WHERE has_server OR has_extra", _LINKED
    ),
    "relink_statuses": _with(_STATUS_TEXT, _LINKED, _BRIDGE_STATUS),
    "resanitized_statuses": _with(_STATUS_TEXT, _LINKED, _BRIDGE_STATUS),
    "resanitized_servers": _with("SELECT k AS doc_id, bridge, published, extra_digest, server_digest FROM full_links WHERE has_server", _LINKED),
    "late_extra_infos": _with("SELECT bridge, published, extra_digest, server_digest FROM full_links WHERE has_server", _LINKED),
    "rewritten_statuses": _with(
        _STATUS_TEXT.replace("f.server_digest", "CASE WHEN hit.noon IS NULL THEN e.early ELSE f.server_digest END").replace(
            "WHERE s.k % 9", f"LEFT JOIN early e ON e.k = s.m LEFT JOIN hit ON hit.noon = {_NOON} WHERE s.k % 9"
        ),
        _LINKED, _BRIDGE_STATUS,
        # Digests while only the extra-infos of even documents were there, and times of statuses near a change.
        f"""early AS (SELECT k, published, server_digest, CASE WHEN has_server THEN
   sha1({_SCRUBBED_SERVER.format(digest=f'CASE WHEN k % 2 = 0 THEN upper(extra_digest) ELSE {_ZEROS} END')}) ELSE {_ZEROS} END AS early FROM full_links)""",
        f"""hit AS (SELECT DISTINCT noon FROM (SELECT DISTINCT {_NOON} AS noon FROM (SELECT o_orderkey AS k FROM orders) s) n
 JOIN (SELECT DISTINCT CAST(published AS TIMESTAMP) AS changed FROM early WHERE early <> server_digest) c
 ON changed <= noon AND changed >= noon - INTERVAL 24 HOUR)""",
    ),
    **FILE_ORACLES,
}
