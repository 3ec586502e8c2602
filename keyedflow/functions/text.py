"""String expressions. All are built-in column expressions, so they stay in whole-stage codegen.

The rules follow the Java string methods the log format was defined with, which differ from
Spark's own at the edges: `split` drops trailing empty fields, `trim` strips every character up to
U+0020, and number parsing allows no surrounding space.
"""

import re

from pyspark.sql import Column, functions as F

# Every character up to U+0020: what trimming a key removes.
CONTROL_AND_SPACE = "".join(chr(c) for c in range(0x21))

# The characters that count as white space when a field is tested for being blank
# (Unicode space, line and paragraph separators without the non-breaking ones, and the ASCII
# white-space controls).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def split_fields(line: Column, sep: str = ",") -> Column:
    """Split on a one-character separator; trailing empty fields vanish.

    `a,b,,` has two fields, `,,` has none, and the empty line has one empty field.
    """
    if len(sep) != 1:
        raise ValueError("the separator must be one character")
    stripped = F.rtrim(line, F.lit(sep))
    return (
        F.when((line != "") & (stripped == ""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, re.escape(sep)))
    )


def strip_control(text: Column) -> Column:
    """Strip control characters and spaces from both ends (Spark's `trim` strips spaces only)."""
    return F.trim(text, F.lit(CONTROL_AND_SPACE))


def not_blank(text: Column) -> Column:
    """True when the text holds a character other than white space."""
    return F.coalesce(F.length(F.trim(text, F.lit(WHITESPACE))) > 0, F.lit(False))


def strict_integer(text: Column, dtype: str = "bigint") -> Column:
    """Optional sign and ASCII digits only; null for anything else and for values out of range.

    `\\z` rather than `$`, because `$` also matches before a closing newline.
    """
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast(dtype))


def count_blank_is_one(text: Column) -> Column:
    """A 32-bit count where a blank field stands for 1; null marks a bad value."""
    number = strict_integer(text, "int").cast("bigint")
    return F.coalesce(number, F.when(~not_blank(text), F.lit(1).cast("bigint")))


def count_empty_is_zero(text: Column) -> Column:
    """A 64-bit count where an empty field stands for 0; null marks a bad value."""
    return F.when(F.length(text) == 0, F.lit(0).cast("bigint")).otherwise(strict_integer(text))


def md5_key(*parts: Column, sep: str = "") -> Column:
    """Hex md5 over the UTF-8 bytes of the trimmed concatenation.

    Without a separator `ab`+`c` and `a`+`bc` give the same key; that is the format stored keys
    have. Pass `sep` for new data.
    """
    joined = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    return F.md5(strip_control(joined))


def format_percent(number: Column, digits: int = 0) -> Column:
    """`0.1234, 1 -> 12.3%`, grouped in thousands, ties rounded to even."""
    text = F.concat(F.format_number(number * 100, digits), F.lit("%"))
    return F.when(F.isnan(number), F.lit("NaN")).otherwise(text)


def random_surrogate() -> Column:
    """A fresh random md5 key per row (differs on each run, also when a task is retried)."""
    return F.md5(F.concat(F.uuid(), F.rand().cast("string")))


def timed_surrogate(uid: Column) -> Column:
    """A random md5 key from an id, the time in milliseconds and a random number."""
    millis = F.unix_millis(F.current_timestamp()).cast("string")
    return F.md5(F.concat(uid, millis, F.rand().cast("string")))


def salted_surrogate(uid: Column, salt: str) -> Column:
    """The repeatable form: the same id and salt give the same key."""
    return F.md5(F.concat(uid, F.lit(salt)))
