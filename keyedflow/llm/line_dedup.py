"""Drop lines that many documents share, with DataFrame functions only.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least `min_chars` code points
that at least `min_docs` documents hold lose all their lines, except in the document with the largest id among them.

Lines are exploded once into slim rows (id, position, two 64-bit hashes); no text is shuffled for the counting.
Documents per key are counted from distinct (key, document) pairs, so a line that a third of all
documents share is spread by document first and arrives at its count as one partial per task. Dropped positions
return to the documents as one sorted array each, and the text is put together from the slices between them.

Null and empty texts have one empty line, which is never dropped; a null text stays null. A null id is one
document, smaller than all others. Rows of one id are one document: a key in three rows of one id is in one
document. Other columns are passed on; `n_lines` and `n_dropped` replace columns of these names.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, SPACES, UPPER, keeps_other_columns, stored


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _twin_hash(value: Column) -> list[Column]:
    """Two 64-bit hashes, over the value and over a shifted copy of it: 128 bits together."""
    return [F.xxhash64(value), F.xxhash64(F.concat(F.lit("+"), value))]


def _line_rows(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(row1, row2, id, pos, key1, key2) of every line that is long enough to be dropped."""
    rows = docs.select(
        F.struct(F.col(id).alias("id")).alias("doc"),
        *(h.alias(f"row{i}") for i, h in enumerate(_twin_hash(F.col(text)), 1)),
        F.posexplode(_lines(F.col(text))).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(SPACES))
    rows = rows.withColumn("line", key).where(F.char_length("line") >= min_chars)
    folded = F.translate("line", UPPER, LOWER)
    return rows.select(
        "doc", "row1", "row2", "pos", *(h.alias(f"key{i}") for i, h in enumerate(_twin_hash(folded), 1))
    )


def dropped_positions(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """(doc, row1, row2, dropped): for each text that loses lines, their positions from 0, in order."""
    lines = stored(_line_rows(docs, id, text, min_chars), "lines")
    shared = (
        lines.select("key1", "key2", "doc").distinct()
        .groupBy("key1", "key2").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= min_docs).drop("n")
    )
    # Stored, both sides of the join arrive by an exchange of their own, so Spark can split a hot key.
    shared = stored(shared, "shared_lines")
    gone = lines.join(shared, ["key1", "key2"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc", "row1", "row2").agg(
        F.sort_array(F.collect_set("pos")).alias("dropped")
    )


@keeps_other_columns("id", "text")
def line_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """`docs` with the shared lines taken out of `text`; adds `n_lines` (before) and `n_dropped`."""
    marks = dropped_positions(docs, id, text, min_chars, min_docs)
    hashes = _twin_hash(F.col(text))
    left = docs.drop("n_lines", "n_dropped")
    columns = left.columns
    left = left.withColumns({"_row1": hashes[0], "_row2": hashes[1], "_doc": F.struct(F.col(id).alias("id"))})
    marks = marks.select(
        F.col("doc").alias("_doc"), F.col("row1").alias("_row1"), F.col("row2").alias("_row2"),
        F.col("dropped").alias("_dropped"),
    )
    joined = left.join(marks, ["_doc", "_row1", "_row2"], "left")
    joined = joined.withColumn("_lines", _lines(F.col(text)))
    n, cuts = F.size("_lines"), F.concat(F.array(F.lit(-1)), F.col("_dropped"), F.array(F.size("_lines")))
    between = F.transform(
        F.sequence(F.lit(0), F.size("_dropped")),
        lambda i: F.slice("_lines", cuts[i] + 2, cuts[i + 1] - cuts[i] - 1),
    )
    kept = F.when(F.col("_dropped").isNull(), F.col(text)).otherwise(
        F.array_join(F.flatten(between), "\n")
    )
    return joined.select(
        *(kept.alias(c) if c == text else F.col(c) for c in columns),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
