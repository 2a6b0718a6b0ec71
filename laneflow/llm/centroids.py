"""Clustering of vectors around centroids in exact integers, by a tournament of bisecting planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow.llm.store import table

#: Components up to this size keep all products and sums of a comparison within 64 bits.
_WORD = 1 << 26
#: Sums travel in limbs of so many bits, so that Spark adds up numbers of any size exactly.
_LIMB = 30
_MOST = (1 << 63) - 1


@dataclass(frozen=True)
class ClusterSettings:
    """size: components of a vector; scale: a component x becomes floor(scale * x), scale a power of two; k: centroids; rounds: of
    assignment and replacement before the last assignment; seed: text hashed with an id to choose the first centroids."""

    size: int = 64
    scale: int = 64
    k: int = 16
    rounds: int = 3
    seed: str = "1:"


class Bisectors:
    """Integer normals and thresholds of all pairs of centroids.

    x is nearer to centroid j than to i if 2 x (c_j - c_i) > |c_j|^2 - |c_i|^2; it stays with the smaller number if both
    sides are equal.
    """

    def __init__(self, centroids: list[list[int]]):
        small = all(abs(v) <= _WORD for c in centroids for v in c)
        self.centroids = np.array(centroids, np.int64 if small else object)
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, and its squared distance. k - 1 sign tests leave one centroid."""
        kind = object if object in (x.dtype, self.centroids.dtype) else np.int64
        x = x.astype(kind, copy=False)
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = (x * self.normals[best, j]).sum(axis=1) - self.thresholds[best, j]
            best[(side > 0).astype(bool)] = j
        apart = x - self.centroids[best]
        return best, (apart * apart).sum(axis=1)


def _whole(values: np.ndarray, settings: ClusterSettings) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit integers if all are small, else as integers of any size."""
    if not len(values) or np.abs(values).max() <= _WORD / settings.scale:
        return np.floor(values * settings.scale).astype(np.int64)
    exact = lambda v: floor(v * settings.scale) if abs(v) < 2.0**53 else int(v) * settings.scale
    return np.array([[exact(v) for v in row] for row in values.tolist()], object)


def _vectors(column: pa.Array, settings: ClusterSettings) -> np.ndarray:
    return _whole(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, settings.size), settings)


def fits(vector: Column, settings: ClusterSettings) -> Column:
    """Whether a vector has `size` components, none null or non-finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    return F.coalesce((F.size(vector) == settings.size) & F.forall(vector, fine), F.lit(False))


def first_centroids(kept: DataFrame, settings: ClusterSettings) -> list[list[int]]:
    """The integer vectors of the k rows whose hash is smallest; ties by the vector, rows without id come last."""
    key = F.sha2(F.concat(F.lit(settings.seed), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), F.transform("embedding", lambda x: x.cast("double"))).limit(settings.k).collect()
    return [_whole(np.array([r.embedding], np.float64), settings)[0].tolist() for r in rows]


def _moved(kept: DataFrame, centroids: list[list[int]], settings: ClusterSettings) -> list[list[int]]:
    """Centroids after one round: floors of the exact means, and the old ones of empty clusters.

    Each task sums its own vectors per cluster and gives out the sums in limbs; what comes to the driver is bounded by
    the number of components.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, sums, counts = Bisectors(centroids), {}, {}
        for batch in batches:
            x = _vectors(batch.column(0), settings)
            best, _ = planes.nearest(x)
            for j in np.unique(best).tolist():
                own = x[best == j]
                # one batch of small integers cannot leave 64 bits; the sum over batches is of any size
                part = own.sum(axis=0).tolist()
                sums[j] = [a + b for a, b in zip(sums[j], part)] if j in sums else part
                counts[j] = counts.get(j, 0) + len(own)
        out = []
        for j, total in sums.items():
            for place, value in enumerate([*total, counts[j]]):
                sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
                while value or not limb:
                    out.append((j, place, limb, sign * (value & ((1 << _LIMB) - 1))))
                    value, limb = value >> _LIMB, limb + 1
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns[:3]], pa.array(columns[3], pa.int64())], names=["cluster", "place", "limb", "value"])

    parts = kept.select("embedding").mapInArrow(run, "cluster int, place int, limb int, value long")
    totals: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value")).collect():
        totals[r.cluster, r.place] = totals.get((r.cluster, r.place), 0) + (r.value << (_LIMB * r.limb))
    return [[totals[j, p] // totals[j, settings.size] for p in range(settings.size)] if (j, settings.size) in totals else c for j, c in enumerate(centroids)]


def clusters(vectors: DataFrame, settings: ClusterSettings = ClusterSettings()) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every kept row of vectors (vec_id, embedding), and the final centroids.

    Kept are rows whose vector has `size` components, none null or non-finite. Centroids start as the k kept vectors of
    the smallest hashes (fewer rows: fewer centroids); each round assigns all and replaces every centroid that has
    vectors by the floor of their mean. Rows that repeat count as often as they stand there; a row without
    vec_id is assigned like any other. distance is squared and exact, null where it doesn't fit a long. No kept
    rows: none come out. Other columns are left out.
    """
    kept = vectors.select("vec_id", "embedding").where(fits(F.col("embedding"), settings))
    centroids = first_centroids(kept, settings)
    if not centroids:  # nothing is kept
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(settings.rounds):
        centroids = _moved(kept, centroids, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for batch in batches:
            best, apart = planes.nearest(_vectors(batch.column(1), settings))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array([v if v <= _MOST else None for v in apart.tolist()], pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), centroids


def clustered(vectors: DataFrame, settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """`clusters` with cluster_inertia, inertia (sums of distances, null if they don't fit a long) and centroid_sha256.

    The sums of at most k clusters come back to the driver and go out with the rows.
    """
    rows, centroids = clusters(vectors, settings)
    rows = table(rows, "clustered")
    found = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown")).collect()
    sums = {r.cluster: None if r.unknown else int(r.total) for r in found}
    whole = None if None in sums.values() else sum(sums.values())
    long = lambda v: F.lit(v if v is not None and v <= _MOST else None).cast("long")
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    pick = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    if not centroids:
        return rows.select("vec_id", "cluster", "distance", long(None).alias("cluster_inertia"), long(None).alias("inertia"), F.lit(None).cast("string").alias("centroid_sha256"))
    return rows.select("vec_id", "cluster", "distance", pick([long(sums.get(j, 0)) for j in range(len(centroids))]).alias("cluster_inertia"),
                       long(whole).alias("inertia"), pick([F.lit(digest(c)) for c in centroids]).alias("centroid_sha256"))


def _sql() -> str:
    """`clustered` over embeddings with its own settings, as DuckDB SQL: one block of tables per round."""
    assign = """
d{r} as (
  select v.row, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as distance from v, c{r} c),
b{r} as materialized (select row, unnest(min(struct_pack(distance := distance, cluster := cluster))) from d{r} group by row)"""
    move = """
s{r} as (
  select b.cluster, i, sum(v.x[i])::bigint as total, count(*)::bigint as n
  from b{r} b join v using (row), range(1, 65) places(i) group by b.cluster, i),
m{r} as (select cluster, list((total - ((total % n) + n) % n) // n order by i) as x from s{r} group by cluster),
c{n} as materialized (select c.cluster, coalesce(m.x, c.x) as x from c{r} c left join m{r} m using (cluster))"""
    steps = [assign.format(r=r) + "," + move.format(r=r, n=r + 1) for r in range(3)] + [assign.format(r=3)]
    return """
with v as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as x
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (
  select (row_number() over (order by sha256('1:' || vec_id), x) - 1)::int as cluster, x from v order by sha256('1:' || vec_id), x limit 16),""" + ",".join(steps) + """
select v.vec_id, b.cluster, b.distance, (sum(b.distance) over (partition by b.cluster))::bigint as cluster_inertia,
       (sum(b.distance) over ())::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from b3 b join v using (row) join c3 c using (cluster)
"""


SQL = _sql()
