"""JSON form of a state value, for exchange with an external key-value store.

Inside this engine state is kept in typed columns; these are for the edge only.
Formats: `5` (non-transactional), `[batch, value]` (transactional) and
`[batch, value, previous]` (opaque).
"""

from pyspark.sql import Column, functions as F


def encode_state(value: Column, batch_id: Column | None = None, prev: Column | None = None) -> Column:
    value = value.cast("bigint")
    if batch_id is None:
        return F.coalesce(value.cast("string"), F.lit("null"))
    parts = [batch_id.cast("bigint"), value] + ([] if prev is None else [prev.cast("bigint")])
    return F.to_json(F.array(*parts))


def decode_state(text: Column) -> Column:
    """`struct<batch_id, value, prev>`; the parts the text does not hold are null."""
    parts = F.from_json(text, "array<bigint>")
    whole = text.startswith("[")
    return F.struct(
        F.when(whole, F.get(parts, 0)).alias("batch_id"),
        F.when(whole, F.get(parts, 1)).otherwise(text.try_cast("bigint")).alias("value"),
        F.when(whole, F.get(parts, 2)).alias("prev"),
    )
