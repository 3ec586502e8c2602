"""Log lines derived from the `events` table, as SQL text both engines run.

Only the names of the string type and of the date function differ between them. The lines hold
every edge the format has: blank, padded, signed, fractional and oversized counts, padded keys,
trailing commas, an eleventh field and an empty last field.
"""

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    string: str
    day: str  # of ts, as yyyyMMdd
    dashed_day: str  # of ts, as yyyy-MM-dd


SPARK = Dialect("string", "date_format(ts, 'yyyyMMdd')", "date_format(ts, 'yyyy-MM-dd')")
DUCKDB = Dialect("varchar", "strftime(ts, '%Y%m%d')", "strftime(ts, '%Y-%m-%d')")

# Accepted with extra trailing commas, rejected with an eleventh field.
_SUFFIX = """
    case when event_id % 101 = 0 then ',,' when event_id % 103 = 0 then ',extra' else '' end"""


def match_lines(d: Dialect) -> str:
    return f"""
    select event_id as seq, ts, concat(concat_ws(',',
        concat('u', user_id), concat('db', event_id % 2), concat('TAB_', upper(event_type)),
        'cmVj', 'ZXh0', concat('6.7.', event_id % 10), concat('n', event_id % 5), 'prod1',
        case when event_id % 11 = 0 then '' when event_id % 13 = 0 then '  '
             when event_id % 89 = 0 then 'x' when event_id % 83 = 0 then '99999999999'
             when event_id % 79 = 0 then '1.5' when event_id % 17 = 0 then '+3'
             else cast(event_id % 5 + 1 as {d.string}) end,
        case when event_id % 97 = 0 then '' else {d.day} end), {_SUFFIX}) as line
    from events"""


def profile_lines(d: Dialect) -> str:
    return f"""
    select event_id as seq, ts, concat(concat_ws(',',
        concat(case when event_id % 53 = 0 then chr(9) else '' end, 'u', user_id),
        concat('pt_', event_id % 7),
        concat(event_type, case when event_id % 59 = 0 then ' ' else '' end),
        concat('n', event_id % 5), concat('l', event_id % 3), concat('5.', event_id % 10),
        concat('p', event_id % 4), concat('g', event_id % 6), {d.dashed_day},
        case when event_id % 97 = 0 then '' else {d.dashed_day} end), {_SUFFIX}) as line
    from events"""


def request_lines(d: Dialect) -> str:
    return """
    select event_id as seq, ts, concat(event_type, '/', user_id % 10) as line from events"""


def raw_profile_lines(d: Dialect) -> str:
    return f"""
    select seq, concat('mid', seq, ',', case when seq % 7 = 0
        then replace(line, ',pt_', ';NULL,pt_') else line end) as line
    from ({profile_lines(d)}) p"""


def tab_lines(d: Dialect) -> str:
    return """
    select event_id as seq, ts, concat(concat_ws(chr(9), event_type, concat('u', user_id), event_type),
        case when event_id % 97 = 0 then concat(chr(9), chr(9)) else '' end) as line
    from events"""


def url_events(d: Dialect) -> str:
    return f"""
    select event_id as seq, ts, concat('s', user_id) as shortid,
        case when event_id % 97 = 0 then '20161301' else {d.day} end as day from events"""


# Three batches by time: everything before, between and after these two times.
BATCH_BOUNDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
