"""Active days as bitmaps: a row for each key and year instead of one for each key and day.

A year has 366 days at most, kept as six 64-bit numbers that are OR-ed: one hashed, partial aggregate in generated code with
a buffer of 48 bytes. (Spark's own bitmap aggregate has a buffer of 4 KB for each group.) OR is associative and may repeat,
so batches are merged in any order, and one that comes twice changes nothing.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 6


def _or(rows: DataFrame, keys: Sequence[str], words: Sequence[Column]) -> DataFrame:
    """One bitmap a key and year from the 64-bit numbers of its rows, of which nulls say nothing."""
    named = rows.select(*keys, "year", *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    merged = named.groupBy(*keys, "year").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])
    bits = F.array(*[F.coalesce(F.col(f"_w{i}"), F.lit(0).cast("bigint")) for i in range(WORDS)])
    return merged.select(*keys, "year", bits.alias("bits"))


def day_bitmaps(rows: DataFrame, keys: Sequence[str], day: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """(keys, year, bits) of the days in text of that form. Other days have no bit: `other_days` gives them."""
    dated = rows.select(*keys, F.try_to_date(day, fmt).alias("_date")).where("_date is not null")
    place = F.dayofyear("_date") - 1
    marked = dated.select(
        *keys, F.year("_date").alias("year"), F.shiftright(place, 6).alias("_word"),
        F.expr("shiftleft(1L, (dayofyear(_date) - 1) % 64)").alias("_bit"),
    )
    return _or(marked, keys, [F.when(F.col("_word") == i, F.col("_bit")) for i in range(WORDS)])


def other_days(rows: DataFrame, keys: Sequence[str], day: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """The distinct keys and days that are no dates of that form and so have no bit."""
    return rows.where(F.try_to_date(day, fmt).isNull()).select(*keys, day).distinct()


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One bitmap for each key and year."""
    return _or(bitmaps, keys, [F.get("bits", F.lit(i)) for i in range(WORDS)])


def unpack_days(bitmaps: DataFrame, keys: Sequence[str], day: str = "day", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """A row for each day whose bit is set."""
    places = F.filter(
        F.sequence(F.lit(0), F.lit(64 * WORDS - 1)),
        lambda i: F.getbit(F.get("bits", F.shiftright(i, 6)), i % 64) == 1,
    )
    date = F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("_place"))
    return bitmaps.select(*keys, "year", F.explode(places).alias("_place")).select(*keys, F.date_format(date, fmt).alias(day))


def count_days(bitmaps: DataFrame, keys: Sequence[str], name: str = "days") -> DataFrame:
    """How many days each key has, counted in the bitmaps."""
    ones = sum((F.bit_count(F.get("bits", F.lit(i))) for i in range(WORDS)), F.lit(0))
    return bitmaps.groupBy(*keys).agg(F.sum(ones).alias(name))
