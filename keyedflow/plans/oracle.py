"""The same queries as SQL for DuckDB, run on the same tables."""

from ..operators.lines import MATCH_FIELDS, PROFILE_FIELDS
from ..operators.profile import KEEP_IDENTITY, REFRESH_IDENTITY
from . import fixtures

_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'"


def _lines(fixture) -> str:
    return f"({fixture(fixtures.DUCKDB)})"


def _split(fixture) -> str:
    return f"""(select seq, ts, line, string_split(regexp_replace(line, ',+$', ''), ',') as f
        from {_lines(fixture)} l)"""


def _key(*indexes: int) -> str:
    joined = " || ".join(f"f[{i}]" for i in indexes)
    return f"md5(regexp_replace({joined}, {_TRIM}))"


MATCH_KEY, PROFILE_KEY = _key(1, 2, 3, 4, 5), _key(1, 3)

# Blank is 1, else a strict 32-bit integer.
COUNT_INT = """case when regexp_replace(f[9], '\\s+', '', 'g') = '' then 1
    when regexp_full_match(f[9], '[+-]?[0-9]+') then cast(try_cast(f[9] as integer) as bigint) end"""
# Empty is 0, else a strict 64-bit integer.
COUNT_LONG = """case when f[9] = '' then 0
    when regexp_full_match(f[9], '[+-]?[0-9]+') then try_cast(f[9] as bigint) end"""


def _match_rows(count: str) -> str:
    fields = ", ".join(f"f[{i + 1}] as {c}" for i, c in enumerate(MATCH_FIELDS) if c != "count")
    return f"""(select * from (select seq, {MATCH_KEY} as row_key, {fields}, {count} as count
        from {_split(fixtures.match_lines)} s where len(f) = 10) r where count is not null)"""


def _match_count(count: str) -> str:
    firsts = ", ".join(f"arg_min_null({c}, seq) as {c}" for c in MATCH_FIELDS[:8])
    return f"""select row_key, {firsts}, cast(sum(count) as bigint) as count
        from {_match_rows(count)} m group by row_key"""


def _profile_rows() -> str:
    fields = ", ".join(f"f[{i + 1}] as {c}" for i, c in enumerate(PROFILE_FIELDS))
    return f"""(select seq, {PROFILE_KEY} as mid, {fields}
        from {_split(fixtures.profile_lines)} s where len(f) = 10)"""


def _profile(firsts) -> str:
    picks = ", ".join(
        f"{'arg_min_null' if c in firsts else 'arg_max_null'}({c}, seq) as {c}"
        for c in PROFILE_FIELDS
    )
    return f"select mid, {picks} from {_profile_rows()} p group by mid"


BATCH_OF = """case when ts < timestamp '{}' then 0
        when ts < timestamp '{}' then 1 else 2 end""".format(*fixtures.BATCH_BOUNDS)


def _request_batches() -> str:
    return f"""(select line, {BATCH_OF} as batch
        from {_lines(fixtures.request_lines)} r)"""


REQUESTS = f"select line as word, count(*) as n from {_lines(fixtures.request_lines)} r group by line"

STATE_LOOKUP = f"""select r.pos, r.word, s.n from (
        select event_id as pos, concat(event_type, '/', user_id % 12) as word from events) r
        left join ({REQUESTS}) s on r.word = s.word"""

KEY_COUNT = f"""select {MATCH_KEY} as row_key, count(*) as n
        from {_split(fixtures.match_lines)} s where len(f) = 10 group by 1"""

REKEYED = f"""select seq, md5(string_split(line, ',')[2] || 's1') || ',' ||
        array_to_string(list_slice(f, 3, len(f)), ',') as line from (select seq, line,
        string_split(regexp_replace(replace(line, ';NULL', ''), ',+$', ''), ',') as f
        from {_lines(fixtures.raw_profile_lines)} l) r where len(f) >= 2"""


def _rejects(fixture, count: str = "0") -> str:
    return f"""select seq, line, reason from (select seq, line,
        case when len(f) <> 10 then 'arity' when {count} is null then 'bad_count' end as reason
        from {_split(fixture)} s) q where reason is not null"""


QUARANTINE = _rejects(fixtures.match_lines, COUNT_INT)

WORDS = f"""select word, count(*) as n from (
    select unnest(string_split(regexp_replace(line, '\\t+$', ''), chr(9))) as word
    from {_lines(fixtures.tab_lines)} t) w group by word"""

_BUCKETS = """(
    select *, 'daily' as cf, day as cq from {rows} a
    union all select *, 'monthly', substr(day, 1, 6) from {rows} b
    union all select *, 'weekly', {weekly} from {rows} c)"""

_URLS = f"""(select * from {_lines(fixtures.url_events)} u
    where try_strptime(day, '%Y%m%d') is not null)"""
_URL_BUCKETS = _BUCKETS.format(
    rows=_URLS, weekly="substr(day, 1, 4) || week(strptime(day, '%Y%m%d'))"
)
_ORDER_BUCKETS = _BUCKETS.format(
    rows="(select o_orderstatus, strftime(o_orderdate, '%Y%m%d') as day from orders)",
    weekly="strftime(strptime(day, '%Y%m%d'), '%G%V')",
)

_EVENT_CELLS = """(
    select row_key, cf, cq, version as ts, c.value from (
        select concat('r', user_id) as row_key, event_type, props, user_id,
            case when event_id % 10 = 0 then -event_id - 1 else event_id end as version
        from events) r
    cross join lateral (values ('info', 'event_type', event_type), ('info', 'props', props),
        ('who', 'uid', concat('u', user_id))) as c(cf, cq, value))"""

_NAMESPACED = f"""(select split_part(line, '/', 1) as namespace, split_part(line, '/', 2) as key,
    '[' || max(batch) || ',' || count(*) || ']' as state, count(*) as n
    from {_request_batches()} b group by 1, 2)"""

RETAINED = f"""select shortid, cf, cq, count(*) as n, max(ts) as last_ts
        from {_URL_BUCKETS} b group by shortid, cf, cq
        having max(ts) >= timestamp '2024-02-10' - to_seconds(case cf when 'daily' then 604800
            when 'weekly' then 2678400 else 31536000 end)"""

CELL_LOOKUP = f"""with cells as (select * from {_EVENT_CELLS} c),
        newest as (select row_key, cf, cq, arg_max(value, ts) as value from cells group by all),
        requests as (select event_id as pos, concat('r', user_id) as row_key,
            case when event_id % 2 = 0 then 0 else event_id end as asked from events),
        probes as (select * from requests cross join
            (values ('info', 'event_type'), ('info', 'none'), ('who', 'uid')) w(cf, cq))
        select p.row_key, p.cf, p.cq, p.pos, p.asked,
            case when p.asked > 0 then e.value else n.value end as value
        from probes p
        left join newest n on n.row_key = p.row_key and n.cf = p.cf and n.cq = p.cq
        left join cells e on e.row_key = p.row_key and e.cf = p.cf and e.cq = p.cq
            and e.ts = p.asked and p.asked > 0"""

UPDATED = """select c_custkey, c_name, c_nationkey,
        coalesce(new_bal, c_acctbal) as c_acctbal, coalesce(new_seg, c_mktsegment) as c_mktsegment
        from customer left join (
            select o_custkey, arg_max(o_orderpriority, o_orderkey) as new_seg,
                arg_max(o_totalprice, o_orderkey) filter (where o_orderstatus = 'F') as new_bal
            from orders group by o_custkey) u on o_custkey = c_custkey"""

BAD_DAYS = f"""select seq, shortid, day, 'bad_date' as reason
        from {_lines(fixtures.url_events)} u where try_strptime(day, '%Y%m%d') is null"""

# The middle batch delivered again: with other lines in its place, or counted twice.
REPLACED = f"""select case when batch = 1 then 'again/' || line else line end as word,
        count(*) as n from {_request_batches()} b group by 1"""
TWICE = f"""select line as word,
        cast(sum(case when batch = 1 then 2 else 1 end) as bigint) as n
        from {_request_batches()} b group by 1"""

ORACLE: dict[str, str] = {
    "parse_fields": f"""select seq, {", ".join(
        f"f[{i + 1}] as {c}" for i, c in enumerate(MATCH_FIELDS))}
        from {_split(fixtures.match_lines)} s where len(f) = 10""",
    "quarantine": QUARANTINE,
    "quarantine_stream": QUARANTINE,
    "row_key": f"""select 'profile' as kind, seq, {PROFILE_KEY} as key
        from {_split(fixtures.profile_lines)} p where len(f) = 10
        union all select 'match', seq, {MATCH_KEY}
        from {_split(fixtures.match_lines)} m where len(f) = 10""",
    "etl_rows": f"select seq, row_key, {', '.join(MATCH_FIELDS[1:])} from {_match_rows(COUNT_LONG)} m",
    "rekey_lines": REKEYED,
    "rekey_files": f"select line from ({REKEYED}) r",
    "format_percent": """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        format('{:,.1f}%', l_discount * 100) as discount_pct,
        format('{:,.2f}%', -l_tax * 100) as tax_pct,
        format('{:,.0f}%', l_quantity * 100) as quantity_pct from lineitem""",
    "match_count": _match_count(COUNT_INT),
    "match_count_stream": _match_count(COUNT_INT),
    "match_sum_state": _match_count(COUNT_LONG),
    "match_sum_stream": _match_count(COUNT_LONG),
    "request_count": REQUESTS,
    "request_count_stream": REQUESTS,
    "compacted_table": REQUESTS,
    "replay_transactional": REQUESTS,
    "key_count": KEY_COUNT,
    "key_count_stream": KEY_COUNT,
    "global_count": "select '__global__' as key, count(*) as n from events",
    "word_count": WORDS,
    "word_count_stream": WORDS,
    "each_word_count": WORDS,
    "partition_word_count": WORDS,
    "document_word_count": """select word, count(*) as n from (
        select unnest(string_split(regexp_replace(text, ' +$', ''), ' ')) as word from documents) w
        group by word""",
    "profile_upsert_keep": _profile(KEEP_IDENTITY),
    "profile_upsert_refresh": _profile(REFRESH_IDENTITY),
    "profile_stream": _profile(KEEP_IDENTITY),
    "profile_refresh_stream": _profile(REFRESH_IDENTITY),
    "profile_days": f"select distinct mid, last_date as day from {_profile_rows()} p",
    "profile_days_stream": f"select distinct mid, last_date as day from {_profile_rows()} p",
    "range_scan": """select o_orderkey, o_orderpriority from orders
        where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-01-01'""",
    "insert_if_absent": """select c_custkey, c_name from customer
        union all select c_custkey, arg_min(c_name, seq) from (
            select o_custkey + 500 as c_custkey, concat('Order#', o_orderkey) as c_name,
                o_orderkey as seq from orders) o
        where c_custkey not in (select c_custkey from customer) group by c_custkey""",
    "update_by_key": UPDATED,
    "update_stored": UPDATED,
    "delete_by_key": """select * from customer where c_custkey not in (
        select o_custkey from orders where o_orderstatus = 'P')""",
    "state_lookup": STATE_LOOKUP,
    "table_lookup": STATE_LOOKUP,
    "replay_opaque": REPLACED,
    "replay_non_transactional": TWICE,
    "snapshot_new_checkpoint": _match_count(COUNT_INT),
    "delete_then_first_batch": f"""select line as word, count(*) as n from {_request_batches()} b
        where not (batch = 0 and line in (select line from {_request_batches()} c
            where batch = 0 and line like 'click/%')) group by 1""",
    "late_batch_after_fold": REQUESTS,
    "global_count_stream": "select '__global__' as key, count(*) as n from events",
    "namespaced_stream": f"select namespace, key, n from {_NAMESPACED} k",
    "match_sum_rejects": _rejects(fixtures.match_lines, COUNT_LONG),
    "key_count_rejects": _rejects(fixtures.match_lines),
    "profile_rejects": _rejects(fixtures.profile_lines),
    "deleted_keys": f"""select line as word, count(*) as n from {_request_batches()} b
        where not (batch = 0 and line like 'click/%') group by 1""",
    "kv_namespaced": f"select namespace, key, state from {_NAMESPACED} k",
    "namespaced_lookup": f"""select c_custkey as pos, cast(c_custkey % 13 as varchar) as key, n
        from customer left join {_NAMESPACED} k
        on k.namespace = 'click' and k.key = cast(c_custkey % 13 as varchar)""",
    "cells_put": f"select * from {_EVENT_CELLS} c",
    "cell_lookup": CELL_LOOKUP,
    "cells_stream": CELL_LOOKUP,
    "counter_increment": """select row_key, cf, cq, cast(2 * count(*) as bigint) as value from (
        select concat('r', user_id) as row_key, 'daily' as cf, event_type as cq from events
        union all select concat('r', user_id), 'daily', 'hits' from events
        union all select concat('r', user_id), 'all', 'hits' from events) c group by all""",
    "calendar_rollup": f"select shortid, cf, cq, count(*) as n from {_URL_BUCKETS} b group by all",
    "calendar_rollup_iso": f"""select o_orderstatus, cf, cq, count(*) as n
        from {_ORDER_BUCKETS} b group by all""",
    "rollup_bad_days": BAD_DAYS,
    "rollup_rejects": BAD_DAYS,
    "rollup_retention": RETAINED,
    "rollup_stream": RETAINED,
    "counter_stream": f"""select row_key, cf, cq, count(*) as value from (
        select shortid as row_key, 'daily' as cf, day as cq from {_lines(fixtures.url_events)} a
        union all select shortid, 'daily', 'hits' from {_lines(fixtures.url_events)} b
        union all select shortid, 'all', 'hits' from {_lines(fixtures.url_events)} c) h
        group by all""",
    "archive_daily": f"""select line as value, '2024-02-01' as dt, count(*) as n
        from {_lines(fixtures.request_lines)} r group by line""",
}

from .event_oracle import EVENT_ORACLE  # noqa: E402  it uses the fragments above

ORACLE |= EVENT_ORACLE
