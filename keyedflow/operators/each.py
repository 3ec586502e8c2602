"""The escape hatch for logic no column expression covers: a function over Arrow batches."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def each(
    rows: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: str,
    setup: Callable[[], object] | None = None,
    cleanup: Callable[[object], None] | None = None,
) -> DataFrame:
    """Apply `fn` to each Arrow batch; it may return any number of rows.

    With `setup`, its result (a connection, a model) is made once per task, passed to `fn` as the
    second argument, and handed to `cleanup` when the task ends, also when it fails.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup() if setup else None
        try:
            for batch in batches:
                yield fn(batch, resource) if setup else fn(batch)
        finally:
            if cleanup:
                cleanup(resource)

    return rows.mapInPandas(run, schema)
