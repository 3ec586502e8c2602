import math
import random
from hashlib import sha256

import pytest
from pyspark.errors import PySparkException

from keyedflow.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, v int, id string"


def brute(rows, clusters=8, rounds=10, seed=3, dims=64, scale=1024):
    """rows: (id, vector). Sorted (id, cluster, distance, cluster inertia, inertia, digest)."""
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for n in range(len(centres)):
            mine = [v for (_, v), m in zip(kept, of) if m == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in last if m == n) for n in range(len(centres))}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in last), key=lambda r: tuple(map(str, r))
    )


def rows_of(df):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


def run(df, **options):
    return rows_of(centroids.with_clusters(centroids.cluster(df, **options)))


def test_query(spark, sf_dir):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = rows_of(queries.op11_centroid_clusters(spark, sf_dir))
    assert got == brute(table) and len({r[1] for r in got}) == 8


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(5)
    half = [0.5, -0.5, 0.25, -0.25, 0.0, -0.0009765625, 1e-30, -1e-30]
    vectors = [[rng.choice(half) for _ in range(4)] for _ in range(60)]  # many ties
    vectors += [[0.5] * 4] * 80  # copies
    vectors += [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 1.0, 1.0], [float("nan")] * 4, [1.0, 2.0, float("inf"), 0.0],
                [0.0, 0.0, -float("inf"), 0.0], [100000.0, -100000.0, 0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(7, [0.125] * 4), (7, [0.25] * 4), (3, vectors[3]), (None, [0.75] * 4)]
    return rows, spark.createDataFrame([(i, v, 1, "x", "y", 2, "z") for i, v in rows], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("options", [
    {}, {"clusters": 1}, {"clusters": 3, "rounds": 1}, {"clusters": 500}, {"rounds": 0}, {"seed": 11, "scale": 8},
])
def test_awkward_vectors(awkward, options):
    rows, df = awkward
    got = run(df, dims=4, **options)
    assert got == brute(rows, dims=4, **options) and len(got) == 145


def test_empty_cluster_stays(spark):
    """Two equal first vectors: the higher number gets none and keeps its place."""
    rows = [(i, [1.0, 1.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    result = centroids.cluster(df, clusters=3, dims=2)
    assert result.sizes == [4, 0, 0] and result.centroids == [[1024, 1024]] * 3 and result.inertias == [0, 0, 0]


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert run(none) == []
    assert run(spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")) == []


def test_too_large(spark):
    df = spark.createDataFrame([(1, [1e9] * 2)], "vec_id long, embedding array<float>")
    with pytest.raises(PySparkException, match="out of range"):
        centroids.cluster(df, dims=2)


def test_floor_of_means(spark):
    rows = [(i, [-(i + 1) / 1024, i / 1024]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert centroids.cluster(df, clusters=1, rounds=1, dims=2).centroids == [[-3, 1]]


def test_plan_is_native_and_sums_are_partial(spark, sf_dir):
    rows = centroids.integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 64, 1024)
    near = rows.select(centroids.nearest("v", "norm", [[0] * 64, [1] * 64])["cluster"].alias("cluster"), "v")
    plan = near.groupBy("cluster").agg({"cluster": "count"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_count" in plan
