"""Delimited log lines: split, check, name the fields, derive the key.

Every function takes a batch or streaming DataFrame and adds no shuffle.
"""

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import count_blank_is_one, count_empty_is_zero, md5_key, split_fields

# Field order of the two comma-separated log formats.
PROFILE_FIELDS = (
    "uid", "ptid", "sid", "n", "ln", "ver", "pid", "geoip_n", "first_date", "last_date",
)
MATCH_FIELDS = ("uid", "db", "tab", "rec", "ext", "ver", "nation", "pid", "count", "date")


@dataclass(frozen=True)
class LineFormat:
    """A line format: its fields, the fields its key is made of, and how its count is read."""

    fields: tuple[str, ...]
    key_fields: tuple[str, ...]
    key_name: str = "row_key"
    count_field: str | None = None
    read_count: Callable[[Column], Column] | None = None
    sep: str = ","
    key_sep: str = ""


PROFILE = LineFormat(PROFILE_FIELDS, ("uid", "sid"), "mid")
MATCH = LineFormat(MATCH_FIELDS, MATCH_FIELDS[:5], "row_key", "count", count_blank_is_one)
MATCH_SUM = LineFormat(MATCH_FIELDS, MATCH_FIELDS[:5], "row_key", "count", count_empty_is_zero)


def _split(lines: DataFrame, line: str, sep: str, arity: int) -> DataFrame:
    """Add the fields of each line as the array `_fields`, unless that was done before.

    The array goes through a one-element `explode`. Filters on the fields would otherwise be pushed
    below the split with a copy of it for every use, and each line would be split many times.
    """
    if "_fields" in lines.columns:
        return lines
    text = F.col(line)
    # Lines of separators only have no field; that matters only where one field is a good line.
    fields = split_fields(text, sep) if arity < 2 else F.split(F.rtrim(text, F.lit(sep)), re.escape(sep))
    return lines.select("*", F.explode(F.array(fields)).alias("_fields"))


def parse_fields(
    lines: DataFrame, fields: Sequence[str], line: str = "line", keep: Sequence[str] = ("seq",),
    sep: str = ",",
) -> DataFrame:
    """Keep lines with exactly `len(fields)` fields and name them."""
    parts = F.col("_fields")
    return (
        _split(lines, line, sep, len(fields))
        .where(F.size(parts) == len(fields))
        .select(*keep, *[F.get(parts, i).alias(name) for i, name in enumerate(fields)])
    )


def keyed_lines(
    lines: DataFrame, fmt: LineFormat, line: str = "line", keep: Sequence[str] = ("seq",)
) -> DataFrame:
    """Good lines as named columns behind their key; a count field becomes a bigint."""
    rows = parse_fields(lines, fmt.fields, line, keep, fmt.sep)
    key = md5_key(*[F.col(c) for c in fmt.key_fields], sep=fmt.key_sep).alias(fmt.key_name)
    if fmt.count_field is None:
        return rows.select(*keep, key, *fmt.fields)
    count = fmt.read_count(F.col(fmt.count_field)).alias(fmt.count_field)
    columns = [count if c == fmt.count_field else F.col(c) for c in fmt.fields]
    return rows.select(*keep, key, *columns).where(F.col(fmt.count_field).isNotNull())


def line_keys(
    lines: DataFrame, fmt: LineFormat, line: str = "line", keep: Sequence[str] = ("seq",)
) -> DataFrame:
    """Only the key of each line with the right number of fields."""
    key = md5_key(*[F.col(c) for c in fmt.key_fields], sep=fmt.key_sep).alias(fmt.key_name)
    return parse_fields(lines, fmt.fields, line, keep, fmt.sep).select(*keep, key)


def check_lines(lines: DataFrame, fmt: LineFormat, line: str = "line") -> DataFrame:
    """Add `reason`: `arity`, `bad_count`, or null for a good line; and the fields as `_fields`."""
    parts = F.col("_fields")
    arity_ok = F.coalesce(F.size(parts) == len(fmt.fields), F.lit(False))
    reason = F.when(~arity_ok, F.lit("arity"))
    if fmt.count_field is not None:
        count = fmt.read_count(F.get(parts, fmt.fields.index(fmt.count_field)))
        reason = reason.when(count.isNull(), F.lit("bad_count"))
    return _split(lines, line, fmt.sep, len(fmt.fields)).withColumn("reason", reason)


def quarantine(lines: DataFrame, fmt: LineFormat, line: str = "line") -> DataFrame:
    """The complement of `keyed_lines`: each rejected line, unchanged, with its reason."""
    return check_lines(lines, fmt, line).drop("_fields").where("reason is not null")


def rekey_lines(
    lines: DataFrame, key: Column, line: str = "line", sep: str = ",", drop_literal: str = ";NULL"
) -> DataFrame:
    """Take the literal out, and replace the two leading fields of each line by `key`.

    Lines of fewer than two fields are left out; `short_lines` gives those.
    """
    cleaned = lines.withColumn("_cleaned", F.replace(F.col(line), F.lit(drop_literal), F.lit("")))
    fields = F.col("_fields")
    rest = F.slice(fields, F.lit(3), F.size(fields) - 2)
    split = _split(cleaned, "_cleaned", sep, 2).where(F.size(fields) >= 2)
    rekeyed = F.concat(key, F.lit(sep), F.array_join(rest, sep))
    return split.withColumn(line, rekeyed).drop("_cleaned", "_fields")


def short_lines(
    lines: DataFrame, line: str = "line", sep: str = ",", drop_literal: str = ";NULL"
) -> DataFrame:
    """The lines that `rekey_lines` leaves out, unchanged, with the reason."""
    cleaned = F.replace(F.col(line), F.lit(drop_literal), F.lit(""))
    split = _split(lines.withColumn("_cleaned", cleaned), "_cleaned", sep, 2)
    short = split.where(~F.coalesce(F.size("_fields") >= 2, F.lit(False)))
    return short.drop("_cleaned", "_fields").withColumn("reason", F.lit("arity"))
