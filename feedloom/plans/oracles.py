"""The queries of ``queries.py`` as plain SQL for an independent engine."""

from __future__ import annotations

from feedloom.contract import ADDRESS_CHARACTERS, CONTINENTS, LETTERS, SORT_KEYS
from feedloom.plans import queries as q

_CONTINENT_LIST = "[" + ", ".join(f"'{c}'" for c in CONTINENTS) + "]"

_ORDERS = """
base AS (
  SELECT concat_ws(',', o_orderkey, c_name, o_orderpriority, r_name) AS line, o_orderkey AS k, c_name,
    CAST(o_orderkey % 4 AS INTEGER) AS part, o_orderkey // 4 AS off, o_orderdate AS ts
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CLEAN = _ORDERS + """,
feed AS (SELECT line AS value, part, off, ts FROM base)"""

_DIRTY = _ORDERS + """,
feed AS (SELECT part, off, ts, CASE k % 50
  WHEN 0 THEN replace(line, ',', ';')
  WHEN 1 THEN concat_ws(',', k, c_name)
  WHEN 2 THEN concat_ws(',', k, c_name, 'a')
  WHEN 3 THEN 'x' || line
  WHEN 4 THEN line || ',tail'
  WHEN 5 THEN ' ' || line
  WHEN 6 THEN '+' || line
  ELSE line END AS value FROM base)"""

_EVENTS = f"""
feed AS (SELECT concat_ws(',', event_id, event_type, props, {_CONTINENT_LIST}[user_id % 6 + 1]) AS value,
  CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, ts FROM events)"""

_DOCUMENTS = """
feed AS (SELECT concat_ws(',', doc_id, lang, source, text) AS value,
  CAST(doc_id % 4 AS INTEGER) AS part, doc_id // 4 AS off, NULL::TIMESTAMP AS ts FROM documents)"""

_PARSED = """,
fields AS (SELECT part, off, ts, value AS raw, length(value) - length(replace(value, ',', '')) AS commas,
  CASE WHEN regexp_full_match(string_split(value, ',')[1], '[+-]?[0-9]+')
    THEN try_cast(string_split(value, ',')[1] AS BIGINT) END AS id,
  string_split(value, ',')[2] AS name, string_split(value, ',')[3] AS address,
  regexp_extract(value, '^[^,]*,[^,]*,[^,]*,(.*)$', 1, 's') AS continent FROM feed),
tagged AS (SELECT *, CASE WHEN commas = 0 THEN 'missing field 1' WHEN commas = 1 THEN 'missing field 2'
  WHEN commas = 2 THEN 'missing field 3' WHEN id IS NULL THEN 'bad id' END AS error FROM fields),
ok AS (SELECT * FROM tagged WHERE error IS NULL),
arrived AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY off) AS rank FROM ok)"""

_PLACE = 'part AS "partition", off AS "offset"'


def _on(feed: str, select: str) -> str:
    return f"WITH {feed}{_PARSED}\n{select}"


def _order(key: str) -> str:
    return "id, part, off" if key == "id" else f"{key}, id, part, off"


def _ordering(key: str) -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY {_order(key)}) AS pos, "
        f"raw, id, name, continent, {_PLACE} FROM ok"
    )


def _per_key(select: str) -> str:
    return "\nUNION ALL\n".join(select.format(key=key, order=_order(key)) for key in SORT_KEYS)


_RUNS = ",\nrunning AS (SELECT *, (rank - 1) // {flush} AS run FROM arrived)\n".format(flush=q.FLUSH) + _per_key(
    "SELECT '{key}' AS key, part AS \"partition\", run, "
    "row_number() OVER (PARTITION BY part, run ORDER BY {order}) AS pos_in_run, raw FROM running"
)

_KEYED = _per_key(
    "SELECT '{key}' AS key, row_number() OVER (ORDER BY {order}) AS pos, raw FROM ok"
)

_FAULTY = f""",
placed AS ({_KEYED}),
faulty AS (SELECT * FROM placed WHERE key = 'id' AND pos % {q.FAULT_EVERY} <> 0
  UNION ALL SELECT * FROM placed WHERE key = 'name'
  UNION ALL SELECT * FROM placed WHERE key = 'name' AND pos % {q.FAULT_EVERY} = 0
  UNION ALL SELECT p.* FROM placed p, range(2) r(i) WHERE key = 'continent' AND pos % 2 = 1
    AND (i = 0 OR pos < (SELECT count(*) FROM ok)))"""

_SORTEDNESS = _per_key(
    "SELECT 'ordering' AS subject, '{key}' AS key, count(*) AS rows,"
    " count(*) FILTER (WHERE falls) AS inversions,"
    " min(pos) FILTER (WHERE falls) AS first_bad_pos, count(*) FILTER (WHERE falls) = 0 AS is_sorted"
    " FROM (SELECT pos, lag(k) OVER (ORDER BY pos) > k AS falls FROM"
    " (SELECT row_number() OVER (ORDER BY {order}) AS pos, {key} AS k FROM ok))"
    "\nUNION ALL\n"
    "SELECT 'arrival', '{key}', count(*), count(*) FILTER (WHERE falls),"
    " min(off) FILTER (WHERE falls), count(*) FILTER (WHERE falls) = 0"
    " FROM (SELECT off, lag({key}) OVER (PARTITION BY part ORDER BY off) > {key} AS falls FROM ok)"
)


def _generate() -> str:
    def digest(salt: str) -> str:
        return f"sha256('{q.SEED}:' || id || ':{salt}')"

    return f"""WITH ids AS (SELECT o_orderkey + 1 AS id FROM orders),
drawn AS (SELECT id, {digest("n")} AS n, {digest("a")} AS a FROM ids),
spread AS (SELECT *, CAST('0x' || substr(a, 50, 15) AS BIGINT) AS s FROM drawn),
made AS (SELECT id,
  substr(regexp_replace(substr(to_base64(unhex(n)), 1, 42), '[0-9+/]', '', 'g') || '{LETTERS}',
    1, CAST(s % 6 + 10 AS INTEGER)) AS name,
  substr(replace(replace(substr(to_base64(unhex(a)), 1, 42), '+', ' '), '/', '') || '{ADDRESS_CHARACTERS}',
    1, CAST((s // 6) % 6 + 15 AS INTEGER)) AS address,
  {_CONTINENT_LIST}[(s // 36) % 6 + 1] AS continent FROM spread)
SELECT id, name, address, continent, concat_ws(',', id, name, address, continent) AS value FROM made"""


def _throughput() -> str:
    day = q.DAY_SECONDS
    return f""",
counted AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '{q.EVENTS_START}')) // {day * 1_000_000} AS interval_no,
  count(*) AS n FROM ok GROUP BY 1),
filled AS (SELECT s.i AS interval_no, coalesce(n, 0) AS records
  FROM (SELECT unnest(range(0, (SELECT max(interval_no) + 1 FROM counted))) AS i) s
  LEFT JOIN counted ON counted.interval_no = s.i),
summed AS (SELECT *, CAST(sum(records) OVER (ORDER BY interval_no) AS BIGINT) AS records_so_far FROM filled)
SELECT interval_no, records, records_so_far, records / {day} AS current_rate,
  records_so_far / ((interval_no + 1) * {day}) AS average_rate FROM summed"""


def _throughput_dirty() -> str:
    day = q.DAY_SECONDS
    return f""",
odd AS (SELECT CASE WHEN off % 97 = 0 THEN NULL WHEN off % 101 = 1 THEN ts + INTERVAL {q.FAR_DAYS} DAY
  ELSE ts END AS ts FROM ok),
counted AS (SELECT CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '{q.EVENTS_LATE_START}')) / {day * 1_000_000})
  AS BIGINT) AS interval_no, count(*) AS n FROM odd GROUP BY 1),
filled AS (SELECT s.i AS interval_no, coalesce(n, 0) AS records
  FROM (SELECT unnest(range((SELECT least(0, min(interval_no)) FROM counted),
    (SELECT max(interval_no) + 1 FROM counted))) AS i) s
  LEFT JOIN counted ON counted.interval_no = s.i),
summed AS (SELECT *, CAST(sum(records) OVER (ORDER BY interval_no) AS BIGINT) AS records_so_far FROM filled)
SELECT interval_no, records, records_so_far, records / {day} AS current_rate,
  CASE WHEN interval_no >= 0 THEN records_so_far / ((interval_no + 1) * {day}) END AS average_rate FROM summed
UNION ALL SELECT interval_no, n, NULL, NULL, NULL FROM counted WHERE interval_no IS NULL"""


def _throughput_stream() -> str:
    """A batch's late rows are judged by the watermark that the batch before it had."""
    day = q.DAY_SECONDS * 1_000_000
    passed = f"(epoch_us({{}}) // 1000 * 1000 - {q.LATE_SECONDS * 1_000_000})"
    return f""",
days AS (SELECT d, ntile({q.RATE_SLICES}) OVER (ORDER BY d) AS slice
  FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM feed)),
sliced AS (SELECT ts, least(slice + CASE WHEN off % {q.HELD_EVERY} = 0 THEN {q.HELD_SLICES} ELSE 0 END,
  {q.RATE_SLICES}) AS slice, (epoch_us(ts) - epoch_us(TIMESTAMP '{q.EVENTS_START}')) // {day} AS interval_no
  FROM ok JOIN days ON date_trunc('day', ts) = d),
ended AS (SELECT *, epoch_us(TIMESTAMP '{q.EVENTS_START}') + (interval_no + 1) * {day} AS ends FROM sliced),
heads AS (SELECT s.slice, max(e.ts) AS seen FROM (SELECT DISTINCT slice FROM sliced) s
  JOIN sliced e ON e.slice <= s.slice - 2 GROUP BY 1),
judged AS (SELECT e.interval_no, e.ends, coalesce(e.ends <= {passed.format("h.seen")}, false) AS late
  FROM ended e LEFT JOIN heads h USING (slice))
SELECT interval_no, count(*) FILTER (WHERE NOT late) AS records, count(*) FILTER (WHERE late) AS late,
  ends <= (SELECT {passed.format("max(ts)")} FROM sliced) AS closed
FROM judged GROUP BY interval_no, ends"""


_RECORDS = f"raw, id, name, address, continent, {_PLACE}, ts AS \"timestamp\""
_PARSE = (
    "SELECT raw, CASE WHEN error IS NULL THEN id END AS id,"
    " CASE WHEN error IS NULL THEN name END AS name,"
    " CASE WHEN error IS NULL THEN address END AS address,"
    f" CASE WHEN error IS NULL THEN continent END AS continent, error, {_PLACE}"
)
_SECONDS = "(epoch_us({0}) - epoch_us({1})) / 1e6"


def all_oracles() -> dict[str, str]:
    idle_cut = _on(_EVENTS, f""",
gaps AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY part ORDER BY ts, off) AS gap FROM ok),
cut AS (SELECT *, max(CASE WHEN gap > {q.HOUR_SECONDS * 1_000_000} THEN 1 ELSE 0 END)
  OVER (PARTITION BY part ORDER BY ts, off) AS past FROM gaps)
SELECT {_RECORDS} FROM cut WHERE past = 0""")
    return {
        "generate_feed": _generate(),
        "scan_feed": f'WITH {_DIRTY} SELECT value, {_PLACE}, ts AS "timestamp" FROM feed',
        "stream_drain": _on(_DIRTY, f'{_PARSE}, ts AS "timestamp" FROM tagged'),
        "scan_lines": f"WITH {_DOCUMENTS} SELECT regexp_replace(l, '\\r$', '') AS line"
                      " FROM (SELECT unnest(string_split(value, chr(10))) AS l FROM feed)",
        "cap_per_partition": _on(_DIRTY, f"SELECT {_RECORDS} FROM arrived WHERE rank <= {q.CAP}"),
        "parse_feed": _on(_DIRTY, f'{_PARSE}, ts AS "timestamp" FROM tagged'),
        "parse_documents": _on(_DOCUMENTS, f"{_PARSE} FROM tagged"),
        "valid_records": _on(_DIRTY, f"SELECT {_RECORDS} FROM ok"),
        "rejects": _on(_DIRTY, f"SELECT raw, {_PLACE}, error FROM tagged WHERE error IS NOT NULL"),
        **{f"sorted_by_{key}": _on(_DIRTY, _ordering(key)) for key in SORT_KEYS},
        "sorted_runs": _on(_DIRTY, _RUNS),
        "merge_runs": _on(_DIRTY, _KEYED),
        "three_orderings": _on(_DIRTY, _KEYED),
        "head_of_ordering": _on(_DIRTY, f"SELECT * FROM ({_KEYED}) WHERE pos <= 20"),
        "intake_stats": _on(_DIRTY, """SELECT part AS "partition", count(*) AS messages,
  count(*) FILTER (WHERE error IS NULL) AS valid, count(error) AS malformed,
  count(*) FILTER (WHERE error = 'missing field 1') AS missing_field_1,
  count(*) FILTER (WHERE error = 'missing field 2') AS missing_field_2,
  count(*) FILTER (WHERE error = 'missing field 3') AS missing_field_3,
  count(*) FILTER (WHERE error = 'bad id') AS bad_id FROM tagged GROUP BY part"""),
        "topic_size": f'WITH {_DIRTY} SELECT part AS "partition", count(*) AS messages,'
                      " max(off) + 1 AS end_offset FROM feed GROUP BY part",
        "throughput": _on(_EVENTS, _throughput()),
        "throughput_dirty": _on(_EVENTS, _throughput_dirty()),
        "throughput_stream": _on(_EVENTS, _throughput_stream()),
        "milestones": _on(_EVENTS, f""",
started AS (SELECT part, min(ts) AS started FROM ok GROUP BY part)
SELECT part AS "partition", rank AS records, ts AS reached_at,
  CASE WHEN ts > started THEN rank / ({_SECONDS.format("ts", "started")}) END AS rate
FROM arrived JOIN started USING (part) WHERE rank % {q.MILESTONE} = 0"""),
        "completion_summary": _on(_EVENTS, f"""SELECT sent, CAST({q.EVENTS_TARGET} AS BIGINT) AS target,
  sent / {float(q.EVENTS_TARGET)}::DOUBLE * 100 AS completion_percent, elapsed_seconds,
  CASE WHEN elapsed_seconds > 0 THEN sent / elapsed_seconds END AS rate,
  sent < {q.EVENTS_TARGET} AS short_of_target
FROM (SELECT count(*) AS sent, {_SECONDS.format("max(ts)", "min(ts)")} AS elapsed_seconds FROM ok)"""),
        "reconcile": _on(_DIRTY, _per_key(
            "SELECT '{key}' AS key, (SELECT count(*) FROM ok) AS produced, count(*) AS delivered,"
            " count(*) = (SELECT count(*) FROM ok) AS counts_match,"
            " count(*) = (SELECT count(*) FROM ok) AND NOT EXISTS"
            " (SELECT raw FROM ok EXCEPT ALL SELECT d.raw FROM"
            " (SELECT raw, row_number() OVER (ORDER BY {order}) AS pos FROM ok) d)"
            " AS contents_match FROM ok"
        )),
        "liveness": _on(_EVENTS, f"""SELECT part AS "partition", count(*) AS valid, max(ts) AS last_valid_at,
  {_SECONDS.format(f"TIMESTAMP '{q.EVENTS_AS_OF}'", "max(ts)")} AS idle_seconds,
  {_SECONDS.format(f"TIMESTAMP '{q.EVENTS_AS_OF}'", "max(ts)")} <= {q.HOUR_SECONDS} AS alive
FROM ok GROUP BY part"""),
        "verify_sorted": _on(_DIRTY, _SORTEDNESS),
        "verify_head": _on(_DIRTY, _per_key(
            "SELECT '{key}' AS key, count(*) AS checked, CASE WHEN count(*) < 2 THEN 'not enough data'"
            " WHEN count(*) FILTER (WHERE falls) = 0 THEN 'sorted' ELSE 'not sorted' END AS status"
            " FROM (SELECT lag(k) OVER (ORDER BY pos) > k AS falls FROM"
            " (SELECT row_number() OVER (ORDER BY {order}) AS pos, {key} AS k FROM ok) WHERE pos <= 20)"
        )),
        "idle_cut": idle_cut,
        "idle_cut_stream": idle_cut,
        "expected_count": _on(_DIRTY, f"""SELECT {_PLACE}, id,
  (SELECT count(*) FROM ok o WHERE o.part = arrived.part) >= {q.EXPECTED} AS complete
FROM arrived WHERE rank <= {q.EXPECTED}"""),
        "fixed_batches": f"""WITH {_CLEAN},
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY off) - 1 AS earlier FROM feed)
SELECT value, {_PLACE}, ts AS "timestamp", earlier // {q.BATCH} AS batch, earlier % {q.BATCH} AS slot
FROM ranked""",
        **{name: _on(feed, f""",
placed AS (SELECT row_number() OVER (ORDER BY {_order("id")}) AS pos, count(*) OVER () AS n FROM ok),
dealt AS (SELECT pos, n // {q.WORKERS} AS share, n % {q.WORKERS} AS rest FROM placed)
SELECT CAST(CASE WHEN pos <= share + rest THEN 0 ELSE (pos - 1 - rest) // share END AS INTEGER) AS shard,
  count(*) AS records, min(pos) AS first_pos, max(pos) AS last_pos FROM dealt GROUP BY 1""")
           for name, feed in (("shard_quota", _CLEAN), ("shard_quota_dirty", _DIRTY))},
        "stream_sort": _on(_DIRTY, _KEYED),
        "incremental_orderings": _on(_DIRTY, _KEYED),
        "publish_lines": _on(_DIRTY, _KEYED),
        "publish_resumed": _on(_DIRTY, _KEYED),
        "drain_replayed": _on(_DIRTY, f'{_PARSE}, ts AS "timestamp" FROM tagged'),
        "offset_gaps": _on(_DIRTY, f""",
taken AS (SELECT part, off FROM ok UNION ALL SELECT part, off FROM ok WHERE off % {q.AGAIN_EVERY} < 3),
ends AS (SELECT part, min(off) AS lo, max(off) AS hi FROM taken GROUP BY part),
spine AS (SELECT part, unnest(range(lo, hi + 1)) AS off FROM ends),
counted AS (SELECT s.part, s.off, count(t.off) AS n FROM spine s LEFT JOIN taken t USING (part, off) GROUP BY ALL),
odd AS (SELECT *, off - row_number() OVER (PARTITION BY part, least(n, 2) ORDER BY off) AS island FROM counted WHERE n <> 1)
SELECT part AS "partition", min(off) AS "first", max(off) AS "last",
  CASE WHEN least(n, 2) = 0 THEN 'missing' ELSE 'repeated' END AS kind
FROM odd GROUP BY part, least(n, 2), island"""),
        "reconcile_diff": _on(_DIRTY, _FAULTY + f""",
made AS (SELECT key, raw FROM ok, (VALUES {", ".join(f"('{k}')" for k in SORT_KEYS)}) k(key)),
came AS (SELECT key, raw FROM faulty),
lost AS (SELECT key, raw, count(*) AS n FROM (SELECT * FROM made EXCEPT ALL SELECT * FROM came) GROUP BY ALL),
extra AS (SELECT key, raw, count(*) AS n FROM (SELECT * FROM came EXCEPT ALL SELECT * FROM made) GROUP BY ALL)
SELECT key, raw, coalesce(l.n, 0) AS missing, coalesce(e.n, 0) AS doubled FROM lost l FULL JOIN extra e USING (key, raw)"""),
        "stream_three_orderings": _on(_DIRTY, _KEYED),
        "lines_to_orderings": _on(_DIRTY, _KEYED),
        "reconcile_faults": _on(_DIRTY, _FAULTY + """,
per_key AS (SELECT key, raw, count(*) AS n FROM faulty GROUP BY ALL),
made AS (SELECT raw, count(*) AS n FROM ok GROUP BY raw),
differ AS (SELECT k.key, count(*) FILTER (WHERE made.n IS DISTINCT FROM coalesce(p.n, 0)) AS n
  FROM (SELECT DISTINCT key FROM faulty) k CROSS JOIN made
  LEFT JOIN per_key p ON p.key = k.key AND p.raw = made.raw GROUP BY k.key)
SELECT key, (SELECT count(*) FROM ok) AS produced, count(*) AS delivered,
  count(*) = (SELECT count(*) FROM ok) AS counts_match,
  count(*) = (SELECT count(*) FROM ok) AND any_value(d.n) = 0 AS contents_match
FROM faulty JOIN differ d USING (key) GROUP BY key"""),
        "verify_faults": _on(_DIRTY, _FAULTY + """
SELECT key, count(*) AS rows, CAST(0 AS BIGINT) AS inversions, CAST(NULL AS BIGINT) AS first_bad_pos,
  true AS is_sorted, count(DISTINCT pos) = count(*) AND max(pos) = count(*) AND min(pos) = 1 AS is_numbered
FROM faulty GROUP BY key"""),
        "verify_head_faults": _on(_DIRTY, _per_key(
            "SELECT 'arrival' AS subject, '{key}' AS key, count(*) AS checked,"
            " CASE WHEN count(*) FILTER (WHERE falls) = 0 THEN 'sorted' ELSE 'not sorted' END AS status"
            " FROM (SELECT lag({key}) OVER (ORDER BY off) > {key} AS falls FROM ok"
            f" WHERE part = 0 AND off <= {q.HEAD_OFFSETS})"
            " UNION ALL SELECT 'one row', '{key}', CAST(1 AS BIGINT), 'not enough data'"
        )),
        "publish_ordering": _on(_DOCUMENTS, _ordering("name")),
        "write_runs": _on(_DIRTY, _RUNS),
        "write_feed": f'WITH {_CLEAN} SELECT value, {_PLACE}, ts AS "timestamp" FROM feed',
    }
