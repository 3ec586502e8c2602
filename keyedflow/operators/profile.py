"""Profile upsert: one row per device with first-seen and last-seen attributes, and active days."""

from pyspark.sql import DataFrame, functions as F

from .lines import PROFILE_FIELDS
from .merge import Merge

# The columns an update leaves as first stored, for the two forms of the upsert.
KEEP_IDENTITY = ("uid", "sid", "first_date")
REFRESH_IDENTITY = ("first_date",)

DAYS = Merge(keys=("mid", "day"))


def profile_merge(firsts=KEEP_IDENTITY, order=("seq",)) -> Merge:
    lasts = tuple(c for c in PROFILE_FIELDS if c not in firsts)
    return Merge(keys=("mid",), firsts=tuple(firsts), lasts=lasts, order=order)


def profile_upsert(rows: DataFrame, firsts=KEEP_IDENTITY, order=("seq",)) -> DataFrame:
    """Insert or update per `mid`; `firsts` stay as first seen, the others follow the last row."""
    return profile_merge(firsts, order).aggregate(rows).select("mid", *PROFILE_FIELDS)


def profile_days(rows: DataFrame) -> DataFrame:
    """The distinct days each device was active."""
    return DAYS.aggregate(rows.select("mid", F.col("last_date").alias("day")))
