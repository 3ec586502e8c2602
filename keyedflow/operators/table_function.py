"""A user function over single rows whose output is appended to the fields of its input: a table function in a lateral join.

`each` hands over whole batches and replaces their columns. Here a function gets the values of some fields and yields 0 to n
tuples; each comes out behind the row it came from. Registered under a name, it is called from SQL:

    select t.seq, w.word from t, lateral split_words(t.line) w

Rows travel pickled, many at a time; Spark's Arrow form makes a batch of its own for each row. The function itself is called for
each row, so use column expressions where they can say it.
"""

from collections.abc import Callable, Iterable, Sequence
from decimal import Decimal
from numbers import Real

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RowFunction = Callable[..., Iterable[tuple]]

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_KINDS = {T.BooleanType: bool, T.BinaryType: (bytes, bytearray), T.DecimalType: Decimal}


def _unfit(value: object, kind: T.DataType) -> TypeError:
    return TypeError(f"{value!r} is no {kind.simpleString()}")


def _fitting(kind: T.DataType) -> Callable:
    """Values for a column of this type. Pickled, a number of another type would come out null and one too large would wrap."""
    if type(kind) in _BITS:
        top = 1 << _BITS[type(kind)] - 1

        def fit(v):
            if v.__class__ is not int:
                if isinstance(v, bool) or not isinstance(v, Real) or v != v:
                    raise _unfit(v, kind)
                v = int(v)
            if not -top <= v < top:
                raise _unfit(v, kind)
            return v
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        def fit(v):
            if isinstance(v, bool) or not isinstance(v, Real):
                raise _unfit(v, kind)
            return float(v)
    elif type(kind) is T.StringType:
        def fit(v):
            if v.__class__ is str:
                return v
            plain = isinstance(v, (bool, int, float)) and type(v).__module__ == "builtins"
            return v if plain else str(v)
    elif type(kind) in _KINDS:
        def fit(v):
            if isinstance(kind, T.BooleanType) and type(v).__name__ in ("bool", "bool_"):  # of numpy, too
                return bool(v)
            if not isinstance(v, _KINDS[type(kind)]):
                raise _unfit(v, kind)
            return v
    elif isinstance(kind, T.ArrayType):
        item = _fitting(kind.elementType)

        def fit(v):
            return [item(x) for x in v]
    elif isinstance(kind, T.MapType):
        key, item = _fitting(kind.keyType), _fitting(kind.valueType)

        def fit(v):
            return {key(a): item(b) for a, b in dict(v).items()}
    elif isinstance(kind, T.StructType):
        names, items = kind.names, [_fitting(f.dataType) for f in kind]

        def fit(v):
            v = [v.get(n) for n in names] if isinstance(v, dict) else v
            if len(v) != len(items):
                raise _unfit(v, kind)
            return tuple(f(x) for f, x in zip(items, v))
    else:
        return lambda v: v  # Spark itself refuses what is no date or time
    return lambda v: None if v is None else fit(v)


def _table_function(
    fn: RowFunction, schema: str, setup: Callable[[], object] | None = None,
    cleanup: Callable[[object], None] | None = None, keep_empty: bool = False,
):
    # The row for nothing is yielded here: Spark 4.1 plans a left lateral join with a Python function like an inner one.
    fit = _fitting(T.StructType.fromDDL(schema))
    nothing = (None,) * len(T.StructType.fromDDL(schema)) if keep_empty else None

    class Each:
        def __init__(self):
            self.resource = setup() if setup else None

        def eval(self, *values):
            found = nothing
            for found in fn(*values, self.resource) if setup else fn(*values):
                yield fit(found)
            if found is nothing and keep_empty:
                yield nothing

        def terminate(self):
            if cleanup:
                cleanup(self.resource)

    return F.udtf(Each, returnType=schema, useArrow=False)


def append_each(
    rows: DataFrame, fn: RowFunction, inputs: Sequence[str], schema: str, keep_empty: bool = False,
    setup: Callable[[], object] | None = None, cleanup: Callable[[object], None] | None = None,
) -> DataFrame:
    """`rows` with the columns of `schema` behind its own: a row for each tuple that `fn` yields for the values of `inputs`.

    keep_empty: a row for which nothing is yielded stays, with nulls. With `setup`, its result is made once a task, passed to `fn`
    as the last argument and handed to `cleanup` at the end of the task's rows.
    """
    table = _table_function(fn, schema, setup, cleanup, keep_empty)
    return rows.lateralJoin(table(*[F.col(c).outer() for c in inputs]), how="inner")


def register_each(spark: SparkSession, name: str, fn: RowFunction, schema: str) -> None:
    """Make `fn` a table function of this session's SQL."""
    spark.udtf.register(name, _table_function(fn, schema))
