"""Quality rules by document and by host.

Each document is measured by itself. A host (the `source` of the documents) is judged by how often its documents fail
each rule: the failure rate is shrunk towards the rate of all hosts by a beta prior fitted to the hosts'
rates, so a host of few documents is judged mildly. Host verdicts are joined back to the documents:

- a host is blocked when its shrunk rate of base failures exceeds `BLOCKED`: none of its documents is kept;
- a host is distrusted on a rule when its shrunk rate for it exceeds `DISTRUSTED`: its documents that fail that rule go.

Documents that fail no rule stay, whatever the rate of their source, unless it is blocked.

Null texts have no words and fail the base rule. A null host is a host of its own. Repeated rows count as often as
they occur. An empty table gives an empty one. Other columns are passed on, those with a result's name replaced.
"""

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import keeps_other_columns, slices, stored

#: Fixed rule values: words, share of words in repeated windows; see `base_failed`.
MIN_WORDS, WINDOW = 50, 3
SYMBOLS = "#*$%&|<>"
BLOCKED, DISTRUSTED = 0.9, 0.5

RULE_NAMES = ("base", "symbols", "duplicate_lines", "word_length")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur at least twice, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total, covered = 0, 0  # words counted, and the position up to which they are
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + WINDOW - max(covered, i)
            covered = i + WINDOW
    return total


def measure_text(text: str) -> tuple[int, ...]:
    """The values of MEASURES. Words are runs without white space of U+0020 and U+0009 to U+000D."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, duplicates = set(), 0
    lines = text.split("\n")
    if len(set(lines)) < len(lines):
        for line in lines:
            if line in seen:
                duplicates += bool(line.strip(" \t\n\x0b\x0c\r"))
            seen.add(line)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), chars, symbols, len(lines), duplicates, _repeated_words(words)


@keeps_other_columns("text")
def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the columns of MEASURES (long), over whole texts."""
    kept = docs.drop(*MEASURES)
    schema = T.StructType([*kept.schema, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            rows = [measure_text(t or "") for t in batch.column(at).to_pylist()]
            values = zip(*rows) if rows else [()] * len(MEASURES)
            columns = [*batch.columns, *(pa.array(list(v), pa.int64()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """What a document can fail; ratios by cross-multiplication, so an empty text fails none of them."""
    n = F.col("n_words")
    return {
        "base": base_failed(),
        "symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 15 * n),
    }


def _beta_prior(hosts: int, n: int, squares: float, fails: int, weighted: float) -> tuple[float, float]:
    """(mean, strength) of the prior from the sums over hosts of n, n^2, fails and fails^2 / n.

    The strength is what the correlation of documents within a host implies, between 1 and 1000."""
    if not n or fails in (0, n):
        return (fails or 0) / (n or 1), 1.0
    mean = fails / n
    noise = mean * (1 - mean) * (hosts - 1)
    correlation = (weighted - fails * mean - noise) / max(mean * (1 - mean) * (n - squares / n) - noise, 1e-9)
    return mean, 1 / min(max(correlation, 1 / 1001), 0.5) - 1


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """(host, n, and the shrunk failure rate of each rule): one row per host, pre-aggregated by task."""
    names = list(rules())
    counts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.sum(rule.cast("int")).alias(f"_{name}") for name, rule in rules().items()),
    )
    # A beta-binomial fitted by moments, hosts weighted by their documents; one row of sums.
    sums = counts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("_n").alias("n"),
        F.sum(F.col("_n").cast("double") * F.col("_n")).alias("squares"),
        *(F.sum(f"_{name}").alias(f"a_{name}") for name in names),
        *(F.sum(F.col(f"_{name}").cast("double") * F.col(f"_{name}") / F.col("_n")).alias(f"s_{name}") for name in names),
    ).first()
    rates = {}
    for name in names:
        mean, strength = _beta_prior(sums["hosts"], sums["n"], sums["squares"], sums[f"a_{name}"], sums[f"s_{name}"])
        rates[f"rate_{name}"] = (F.col(f"_{name}") + mean * strength) / (F.col("_n") + strength)
    return counts.select(host, "_n", *(rate.alias(name) for name, rate in rates.items()))


@keeps_other_columns("host", also=MEASURES)
def judge(measured: DataFrame, host: str = "source") -> DataFrame:
    """`measured` with `base_failed` and `kept`. It is read twice, so store it first.

    Only hosts with a verdict against them are joined, a table that is stored so that its size is
    known: Spark broadcasts it if it is small, and otherwise splits a host of very many documents.
    """
    soft = {name: rule for name, rule in rules().items() if name != "base"}
    verdicts = host_rates(measured, host).select(
        F.col(host).alias("_host"), (F.col("rate_base") > BLOCKED).alias("_blocked"),
        *((F.col(f"rate_{name}") > DISTRUSTED).alias(f"_against_{name}") for name in soft),
    )
    against = F.col("_blocked")
    refused = F.col("_blocked")
    for name, rule in soft.items():
        against = against | F.col(f"_against_{name}")
        refused = refused | (F.col(f"_against_{name}") & rule)
    verdicts = stored(verdicts.where(against), "verdicts")
    columns = measured.drop("base_failed", "kept").columns
    joined = measured.select(*columns).join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
    kept = ~base_failed() & ~F.coalesce(refused, F.lit(False))
    return joined.select(*columns, base_failed().alias("base_failed"), kept.alias("kept"))
