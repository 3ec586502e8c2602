"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of words of three lexicons, how often a second person stands near them, rates of capitals,
of exclamation and question marks and of their runs, and of obfuscated spelling. One lexicon is fixed; two are
learned from labelled texts: word beginnings that are much likelier in toxic texts, strongly or moderately so.

Labels are read from the training fold only (crc32(id as text) mod 4 is not 2), for at most `SAMPLE` labelled texts in
expectation, chosen by a hash of the id. They fall into three parts by another hash: one teaches the lexicons, one
the trees, one the calibration, so no part judges what it has taught. The sample is broadcast to the documents, whose
texts are not shuffled, and every document is scored in one pass.

Null and empty texts have zero features and get a score like any other. If a part of the sample lacks one of the two
labels there is nothing to learn: then every score is the share of toxic labels in the sample (0 without any).
Repeated rows score alike; repeated labels of an id count once, as toxic if any is. An empty table gives an empty one. Inputs
of a score are the text and nothing else; other columns are passed on, those with a result's name replaced.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import keeps_other_columns, residue, slices, stored

#: Labelled texts that the models are fitted on, at most (in expectation).
SAMPLE = 20_000
#: Texts of the lexicon part that a word beginning must be in, and the log odds of the two lexicons.
SUPPORT, STRONG, MODERATE = 6, 3.5, 1.5
#: Predicted toxic from this score on.
THRESHOLD = 0.3

# Insults, and second-person words of the four languages.
INSULTS = (
    "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown imbecile fool garbage filthy "
    "ugly freak coward liar jerk hate shut kill"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vos vosotros"
).split()
#: What letters are written as to hide a word.
DISGUISES = str.maketrans("013457@$!", "oieastasi")

FEATURES = (
    "words", "insults", "strong", "moderate", "hits", "near_you", "you", "capitals", "shouted", "marks", "mark_runs",
    "obfuscated", "long_runs",
)
INSULT, STRONG_BIT, MODERATE_BIT, YOU, SHOUTED, OBFUSCATED, LONG_RUN = (1 << i for i in range(7))
#: Words on either side in which a second person counts as near.
NEAR = 5
#: Kinds of words that a worker remembers.
REMEMBERED = 300_000


def plain(word: str) -> str:
    """A word without what surrounds it, in lower case, disguised letters undone."""
    core = word.strip(".,;:!?\"'()[]{}<>«»„“”…|-_").lower()
    if core and not core.isalpha() and any(c.isalpha() for c in core):
        core = core.translate(DISGUISES)
        core = "".join(c for c in core if c.isalpha())
    return core


def beginnings(core: str) -> set[str]:
    """A word and its beginnings of four to six letters, marked as such."""
    return {core, *(f"{core[:n]}*" for n in (4, 5, 6) if len(core) > n)} if len(core) > 2 else set()


class Kinds(dict):
    """word -> its kinds as bits, found on first sight."""

    def __init__(self, strong: frozenset[str], moderate: frozenset[str]):
        self.strong, self.moderate = strong, moderate
        self.insults, self.you = frozenset(INSULTS), frozenset(SECOND_PERSON)

    def __missing__(self, word: str) -> int:
        core = plain(word)
        parts = beginnings(core)
        letters = [c for c in word if c.isalpha()]
        inside = word.strip(".,;:!?\"'()[]{}<>«»„“”…|-_")
        kinds = INSULT * (core in self.insults) | STRONG_BIT * (not self.strong.isdisjoint(parts))
        kinds |= MODERATE_BIT * (not self.moderate.isdisjoint(parts)) | YOU * (core in self.you)
        kinds |= SHOUTED * (len(letters) > 2 and all(c.isupper() for c in letters))
        mixed = bool(letters) and any(c.isdigit() or c in "@$*#" for c in inside)
        kinds |= OBFUSCATED * mixed | LONG_RUN * any(a == b == c for a, b, c in zip(core, core[1:], core[2:]))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = kinds
        return kinds


def features_of(text: str, kinds: Kinds) -> list[float]:
    words = text.split()
    n = len(words)
    bits = np.fromiter(map(kinds.__getitem__, words), np.int64, n)
    share = [float(np.count_nonzero(bits & k)) for k in (INSULT, STRONG_BIT, MODERATE_BIT, YOU, SHOUTED, OBFUSCATED, LONG_RUN)]
    insult, strong, moderate, you, shouted, obfuscated, long_run = (c / max(n, 1) for c in share)
    hits = np.flatnonzero(bits & (INSULT | STRONG_BIT))
    near = 0.0
    if len(hits) and you:
        before = np.concatenate([[0], np.cumsum(bits & YOU != 0)])
        near = float(np.mean(before[np.minimum(hits + NEAR + 1, n)] > before[np.maximum(hits - NEAR, 0)]))
    marks = text.count("!") + text.count("?")
    runs = text.count("!!") + text.count("??") + text.count("!?") + text.count("?!")
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑ")) / max(len(text), 1)
    return [
        math.log1p(n), insult, strong, moderate, math.log1p(len(hits)), near, you, capitals, shouted,
        marks / max(n, 1), runs / max(n, 1), obfuscated, long_run,
    ]


def features(docs: DataFrame, strong: frozenset[str], moderate: frozenset[str], text: str = "text") -> DataFrame:
    """`docs` with `features` (array of double) in place of `text`; whole texts."""
    kept = docs.drop(text, "features")
    schema, width = T.StructType([*kept.schema, T.StructField("features", T.ArrayType(T.DoubleType()))]), len(kept.columns)
    sent = docs.sparkSession.sparkContext.broadcast((strong, moderate))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(*sent.value)
        for batch in slices(batches, width):
            rows = [features_of(t or "", kinds) for t in batch.column(width).to_pylist()]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], values], names=schema.names)

    return docs.select(*kept.columns, F.col(text).alias("_text")).mapInArrow(run, schema)


# -- learning ---------------------------------------------------------------------------------


def labelled(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> DataFrame:
    """(part, label, text) of the sample, stored. part: 0 to 4 lexicons, 5 to 8 trees, 9 calibration."""
    known = labels.where((residue(id, 4) != 2) & F.col(label).isNotNull()).groupBy(id).agg(F.max(label).cast("double").alias("label"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id)), F.lit(1 << 20)) < (1 << 20) * min(sample / max(n, 1), 1.0))
    chosen = chosen.select(
        F.col(id).alias("_id"), F.pmod(F.xxhash64(F.lit("part"), F.col(id)), F.lit(10)).alias("part"), "label"
    )
    texts = docs.where(residue(id, 4) != 2).select(F.col(id).alias("_id"), F.col(text).alias("text"))
    # The sample has a bound, so it goes to the documents and not they to it.
    return stored(texts.join(F.broadcast(chosen), "_id").select("part", "label", "text"), "labelled")


def lexicons(taught: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Strong and moderate word beginnings of toxic texts, from (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[str]] = {}
        for batch in slices(batches, 1):
            parts, labels = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for word in set((text or "").split()):
                    if word not in known:
                        known[word] = beginnings(plain(word))
                    found |= known[word]
                parts += found
                labels += [label] * len(found)
            if len(known) > REMEMBERED:
                known.clear()
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(labels, pa.float64())], names=["part", "label"])

    toxic, total = taught.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not toxic or toxic == total:
        return frozenset(), frozenset()
    found = taught.select("label", "text").mapInArrow(run, "part string, label double")
    counts = found.groupBy("part").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    odds = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("n") - F.col("t") + 0.5) / (total - toxic + 1)))
    # few rows: the sample is bounded, and each has SUPPORT texts of it
    rows = counts.where(F.col("t") >= SUPPORT).select("part", odds.alias("odds")).where(F.col("odds") >= MODERATE).collect()
    strong = frozenset(r["part"] for r in rows if r["odds"] >= STRONG)
    return strong, frozenset(r["part"] for r in rows) - strong


@dataclass
class Scorer:
    strong: frozenset[str]
    moderate: frozenset[str]
    trees: GBTClassificationModel | None
    steps: list[tuple[float, float]]  # calibration: places and values, linear between them
    share: float

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """`docs` with `score` and `predicted` in place of `text`."""
        return _scored(docs, self, text)


@keeps_other_columns("text")
def _scored(docs: DataFrame, scorer: Scorer, text: str) -> DataFrame:
    rows = features(docs, scorer.strong, scorer.moderate, text)
    columns = [c for c in rows.columns if c != "features"]
    value = F.lit(scorer.share)
    if scorer.trees is not None:
        rows = scorer.trees.transform(_vectors(rows))
        value = _interpolated(vector_to_array("_probability")[1], scorer.steps)
    scored = rows.select(*columns, value.cast("double").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _vectors(rows: DataFrame) -> DataFrame:
    named = rows.select("*", *(F.col("features")[i].alias(f"_f{i}") for i in range(len(FEATURES))))
    assembler = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(FEATURES))], outputCol="_features")
    return assembler.transform(named)


def _interpolated(value: Column, steps: list[tuple[float, float]]) -> Column:
    """The calibrated value: linear between the steps, flat beyond them."""
    result = F.lit(steps[-1][1])
    for (x1, y1), (x2, y2) in reversed(list(zip(steps, steps[1:]))):
        inside = F.lit(y1) + (value - x1) * ((y2 - y1) / (x2 - x1) if x2 > x1 else 0.0)
        result = F.when(value < x2, inside).otherwise(result)
    return F.when(value <= steps[0][0], F.lit(steps[0][1])).otherwise(result)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Scorer:
    rows = labelled(docs, labels, id, text, label, sample)
    parts = {"lexicons": F.col("part") < 5, "trees": F.col("part").between(5, 8), "steps": F.col("part") == 9}
    names = list(parts)
    counts = rows.agg(
        F.avg("label").alias("share"),
        *(F.sum(F.when(p & (F.col("label") == v), 1).otherwise(0)).alias(f"{n}_{v}") for n, p in parts.items() for v in (0, 1)),
    ).first()
    share = counts["share"] or 0.0
    if not all(counts[f"{n}_{v}"] for n in names for v in (0, 1)):
        return Scorer(frozenset(), frozenset(), None, [], share)
    strong, moderate = lexicons(rows.where(parts["lexicons"]))
    ready = stored(features(rows.where(~parts["lexicons"]), strong, moderate), "features")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_predicted", maxIter=15, maxDepth=4,
        stepSize=0.2, seed=7, minInstancesPerNode=10,
    ).setProbabilityCol("_probability").setRawPredictionCol("_raw").fit(_vectors(ready.where(parts["trees"])))
    judged = trees.transform(_vectors(ready.where(parts["steps"])))
    judged = judged.select("label", vector_to_array("_probability")[1].alias("_p"))
    isotonic = IsotonicRegression(featuresCol="_p", labelCol="label").fit(judged)
    steps = list(zip(isotonic.boundaries.toArray().tolist(), isotonic.predictions.toArray().tolist()))
    return Scorer(strong, moderate, trees, steps, share)
