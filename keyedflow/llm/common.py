"""What the operators of this package share."""

import inspect
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.files import shared_dir

#: White space of the word rules: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the folder that all executors share, and read from there.

    What is read twice is computed once, and a lost executor takes nothing with it.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each action go when it ends. Only for actions whose results are stored and read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def keeps_other_columns(*named: str, also: Sequence[str] = ()) -> Callable:
    """For an operator on a DataFrame that passes columns on: all but those that its parameters `named`, and `also`, name have
    names of their own while it runs, so that none can meet a name that it uses itself. A result replaces a column of its name.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(operator)
        first = next(iter(signature.parameters))

        @wraps(operator)
        def run(*args, **kwargs) -> DataFrame:
            call = signature.bind(*args, **kwargs)
            call.apply_defaults()
            df, prefix = call.arguments[first], "other"
            used = {call.arguments[name] for name in named} | set(also)
            while any(c.startswith(prefix) for c in df.columns):
                prefix += "_"
            others = {c: f"{prefix}{i}" for i, c in enumerate(df.columns) if c not in used}
            call.arguments[first] = df.withColumnsRenamed(others)
            out, back = operator(*call.args, **call.kwargs), {new: old for old, new in others.items()}
            results = set(out.columns) - set(back)
            return out.drop(*(new for new, old in back.items() if old in results)).withColumnsRenamed(back)

        return run

    return decorate


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about `size` bytes of one text or binary column, to bound what a
    worker holds as Python objects. A single longer value is a part of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def residue(id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: the folds of the learned models."""
    return F.crc32(F.col(id).cast("string")) % modulus
