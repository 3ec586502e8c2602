"""SQL of the queries in `event_queries`."""

from ..operators.lines import MATCH_FIELDS
from . import fixtures
from .oracle import (
    BATCH_OF, COUNT_INT, REPLACED, REQUESTS, TWICE, WORDS, _URL_BUCKETS, _lines, _match_count, _match_rows, _profile_rows, _split,
)

_FIRSTS = ", ".join(f"arg_min_null({c}, seq) as {c}" for c in MATCH_FIELDS[:8])

_DAYS = f"select distinct mid, last_date as day from {_profile_rows()} p"

# The last day of each weekly bucket that exists, plus one.
_PERIOD_ENDS = """(
    select cf, cq, max(d) + interval 1 day as over from (
        select cast(d as date) as d, strftime(d, '%Y%m%d') as day
        from generate_series(timestamp '2023-01-01', timestamp '2025-12-31', interval 1 day) g(d)) days
    cross join lateral (values ('daily', day), ('monthly', substr(day, 1, 6)),
        ('weekly', substr(day, 1, 4) || week(d))) as b(cf, cq)
    group by cf, cq)"""

EVENT_ORACLE = {
    "day_complete_stream": f"""with rows as (select *, date as day from {_match_rows(COUNT_INT)} m)
        select day, row_key, {_FIRSTS}, cast(sum(count) as bigint) as count
        from rows where day < (select max(day) from rows) group by day, row_key""",
    "day_late_rejects_stream": f"""select seq, line, reason from (select seq, line,
        case when len(f) <> 10 then 'arity' when {COUNT_INT} is null then 'bad_count'
            when {BATCH_OF} = 0 then 'late' end as reason
        from {_split(fixtures.match_lines)} s) q where reason is not null""",
    "combiner_count": REQUESTS,
    "combiner_count_stream": REQUESTS,
    "combiner_span": f"""select row_key, min(seq) || '-' || max(seq) || '/' || count(*) as span
        from {_match_rows(COUNT_INT)} m group by row_key""",
    "ordered_lines_match_count": _match_count(COUNT_INT),
    "numbered_lines_files": f"""select line, row_number() over (order by seq) - 1 as number
        from {_lines(fixtures.match_lines)} l""",
    "state_snapshot_stream": _match_count(COUNT_INT),
    "rollup_retention_drop_stored": f"""select shortid, b.cf, b.cq, count(*) as n, max(ts) as last_ts
        from {_URL_BUCKETS} b join {_PERIOD_ENDS} e on e.cf = b.cf and e.cq = b.cq
        where over >= timestamp '2024-02-10' - to_seconds(case b.cf when 'daily' then 604800
            when 'weekly' then 2678400 else 31536000 end)
        group by shortid, b.cf, b.cq""",
    "profile_days_dedup_stream": _DAYS,
    "profile_days_bitmap": _DAYS,
    "profile_day_counts": f"select mid, count(distinct last_date) as days from {_profile_rows()} p group by mid",
    "table_function_word_count": WORDS,
    "batch_table_transactional": REQUESTS,
    "batch_table_opaque": REPLACED,
    "batch_table_non_transactional": TWICE,
    "batch_table_stream": REQUESTS,
}
