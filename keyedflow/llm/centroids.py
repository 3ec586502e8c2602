"""Centroid clustering with JVM-native array expressions over integer vectors.

A vector is kept when it has exactly `dims` components, none of them null, NaN or infinite; a component x becomes the
integer floor(scale * x), with x as a double. All arithmetic after that is on 64-bit integers, so the result does not
depend on partitions, on the order of rows or on retries.

The centroids are array literals in the expression. `zip_with` and `aggregate` give the squared distance to each of
them, and `array_min` over structs (distance, number) the nearest, a tie going to the smaller number. A round is one scan
of the stored integers: the column sums of each cluster are partial aggregates in generated code, so a cluster that
holds a third of all rows sends one row a task. The driver gets `clusters` rows of `dims` sums a round and nothing
that grows with the table. A new centroid is the exact floor of sum / count; an empty cluster keeps its centroid.

The first centroids are the kept vectors with the smallest sha256 of "seed:id", in that order; rows of one id are ordered
by their components. With fewer kept vectors than clusters there are that many clusters. Repeated rows count each time.
A null id is clustered like any other, but starts a centroid only when ids run out. Null, short, long and
non-finite vectors give no row, an empty table gives an empty one. Only the id and the vector are read,
so other columns and their names do no harm. A component whose integer exceeds 2^27 stops the job with an
error, as no 64-bit distance could hold such vectors; so does an inertia above 2^63 - 1.
"""

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: With components up to this, 64 squared differences stay below 2^62.
LARGEST = 1 << 27


@dataclass(frozen=True)
class Clustering:
    """`assigned`: (id, cluster, distance), stored. `centroids`, `sizes` and `inertias` are by cluster number."""

    assigned: DataFrame
    centroids: list[list[int]]
    sizes: list[int]
    inertias: list[int]


def integers(vectors: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """The kept vectors as (id, v, norm): integer components and the sum of their squares."""
    kept = vectors.select(F.col(id).alias("id"), F.col(vector).alias("x")).where(F.size("x") == dims)
    kept = kept.where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))

    def integer(x: Column) -> Column:
        number = F.lit(float(scale)) * x.cast("double")
        large = F.raise_error(F.concat(F.lit("component out of range: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(number) <= LARGEST, F.floor(number)).otherwise(large)

    whole = kept.select("id", F.transform("x", integer).alias("v"))
    return whole.withColumn("norm", F.aggregate("v", F.lit(0).cast("bigint"), lambda total, x: total + x * x))


def distance(v: str, norm: str, centroid: list[int]) -> str:
    """Squared Euclidean distance of a vector to a literal one, |v|^2 + |c|^2 - 2 v c with the first term given.

    SQL text, which is quicker to build than columns.
    """
    literal = f"array({', '.join(f'{-2 * n}L' for n in centroid)})"
    products = f"zip_with({v}, {literal}, (x, y) -> x * y)"
    return f"aggregate({products}, {norm} + {sum(n * n for n in centroid)}L, (total, product) -> total + product)"


def nearest(v: str, norm: str, centroids: list[list[int]]) -> Column:
    """A struct (distance, cluster)."""
    each = (f"named_struct('distance', {distance(v, norm, c)}, 'cluster', {n})" for n, c in enumerate(centroids))
    return F.expr(f"array_min(array({', '.join(each)}))")


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    ordered = rows.select(digest.alias("digest"), "v").orderBy(F.col("digest").asc_nulls_last(), "v")
    return [r["v"] for r in ordered.limit(clusters).collect()]


def _moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the floored means of the clusters, an empty one where it was."""
    dims = len(centroids[0])
    near = rows.select(nearest("v", "norm", centroids)["cluster"].alias("cluster"), "v")
    sums = near.groupBy("cluster").agg(F.expr("count(1) n"), *[F.expr(f"sum(v[{i}]) s{i}") for i in range(dims)])
    moved = list(centroids)
    for row in sums.collect():  # one row a cluster
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return moved


def cluster(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024,
    id: str = "vec_id", vector: str = "embedding",
) -> Clustering:
    """Run `rounds` rounds and assign every kept vector once more."""
    rows = stored(integers(vectors, id, vector, dims, scale), "vectors")
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        none = rows.select(F.col("id").alias(id), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clustering(none, [], [], [])
    for _ in range(rounds):
        centroids = _moved(rows, centroids)
    near = rows.select(F.col("id").alias(id), nearest("v", "norm", centroids).alias("near"))
    assigned = stored(near.select(id, "near.cluster", "near.distance"), "assigned")
    found = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("inertia")).collect()
    by = {r["cluster"]: r for r in found}
    sizes, inertias = ([by[n][c] if n in by else 0 for n in range(len(centroids))] for c in ("n", "inertia"))
    return Clustering(assigned, centroids, sizes, inertias)


def centroid_digest(centroid: list[int]) -> str:
    return sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_clusters(result: Clustering) -> DataFrame:
    """Each vector's cluster and distance with the figures of its cluster, which are literals: one a cluster."""

    def of(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))

    return result.assigned.withColumns({
        "cluster_inertia": of(result.inertias, "bigint"),
        "inertia": F.lit(sum(result.inertias)).cast("bigint"),
        "centroid_sha256": of([centroid_digest(c) for c in result.centroids], "string"),
    })
