"""Near-duplicate vectors by collision counting on one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.links import components
from laneflow.llm.store import table


@dataclass(frozen=True)
class CollisionSettings:
    """cosine: least similarity; half: half width of the window around a vector's projection; groups x each:
    projections; recall: share of linked pairs, at the least similarity, that the collision count may not lose;
    block: vectors of a cell that one step compares with each other."""

    cosine: float = 0.93
    half: float = 0.6
    groups: int = 6
    each: int = 4
    recall: float = 0.9999
    block: int = 512

    @property
    def hit(self) -> float:
        """Chance that a pair at the least similarity collides on one projection."""
        return erf(self.half / sqrt(2 - 2 * self.cosine) / sqrt(2))

    @property
    def count(self) -> int:
        """Collisions a pair needs: the largest number that a linked pair reaches with the wanted recall."""
        n, p = self.groups * self.each, self.hit
        tail = 1.0
        for k in range(n + 1):
            tail -= comb(n, k) * p**k * (1 - p) ** (n - k)
            if tail < self.recall:
                return k
        return n


def _directions(size: int, settings: CollisionSettings) -> np.ndarray:
    """Fixed normal directions for vectors of a size."""
    return np.random.default_rng([size, 5]).standard_normal((size, settings.groups * settings.each))


def _units(blob: list[bytes], size: int) -> np.ndarray:
    x = np.frombuffer(b"".join(blob), np.float64).reshape(-1, size)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, vector) with the vector as bytes of doubles; null where it can be linked with nothing."""
    for batch in batches:
        bodies = []
        for id_, vector, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
            body = None
            if id_ is not None and label is not None and vector and not any(v is None for v in vector):
                x = np.array(vector, np.float64)
                norm = sqrt(float(x @ x)) if np.isfinite(x).all() else 0.0
                body = x.tobytes() if norm and np.isfinite(norm) else None
            bodies.append(body)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bodies, pa.binary())], names=["id", "label", "vector"])


def _spread(settings: CollisionSettings):
    """Rows (label, size, grp, cell, key, id, copies, vector) for every cell that a vector's windows reach upwards."""
    width = 2 * settings.half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            rows, grids, cells, sizes = [], [], [], []
            for row, body in enumerate(batch.column("vector").to_pylist()):
                x = np.frombuffer(body, np.float64)
                size = len(x)
                if size not in known:
                    known[size] = _directions(size, settings)
                at = _units([body], size)[0] @ known[size] / width
                own = np.floor(at).astype(int)
                upper = at - own >= 0.5
                for g in range(settings.groups):
                    mine = slice(g * settings.each, (g + 1) * settings.each)
                    for cell in product(*[(c, c + 1) if u else (c,) for c, u in zip(own[mine].tolist(), upper[mine].tolist())]):
                        rows.append(row)
                        sizes.append(size)
                        grids.append(g)
                        cells.append(",".join(map(str, cell)))
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                taken.column("label"), pa.array(sizes, pa.int32()), pa.array(grids, pa.int32()), pa.array(cells, pa.string()),
                *(taken.column(c) for c in ("key", "id", "copies", "vector"))], names=["label", "size", "grp", "cell", "key", "id", "copies", "vector"])

    return run


def _windows(at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs, each once, whose values on one projection lie in each other's window: sorted, then cut."""
    order = np.argsort(at, kind="stable")
    line = at[order]
    until = np.searchsorted(line, line + half, "right")
    counts = until - np.arange(len(line)) - 1
    first = np.repeat(np.arange(len(line)), counts)
    second = first + 1 + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return order[first], order[second]


def _linked(units: np.ndarray, blocks: np.ndarray, across: bool, size: int, group: int, cell: str, settings: CollisionSettings) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs in one cell that this cell answers for: found by window collisions, then confirmed.

    A pair belongs to the first group in which it collides on all projections, and there to the cell that is the
    higher one on each of them; so it is counted once.
    """
    width, each = 2 * settings.half, settings.each
    at = units @ _directions(size, settings)
    floor, here = np.floor(at[:, group * each : (group + 1) * each] / width).astype(int), np.array(list(map(int, cell.split(","))))
    a, b = _windows(at[:, group * each], settings.half)
    for d in range(each):
        p = at[:, group * each + d]
        near = (np.abs(p[a] - p[b]) <= settings.half) & (np.maximum(floor[a, d], floor[b, d]) == here[d])
        a, b = a[near], b[near]
    keep = np.zeros(len(a), dtype=bool)
    for s in range(0, len(a), 20_000):
        x, y = a[s : s + 20_000], b[s : s + 20_000]
        near = np.abs(at[x] - at[y]) <= settings.half
        whole = near.reshape(len(x), settings.groups, each).all(axis=2)
        ok = (near.sum(axis=1) >= settings.count) & whole.any(axis=1) & (whole.argmax(axis=1) == group)
        if across:
            ok &= blocks[x] != blocks[y]
        ok[ok] = np.einsum("ij,ij->i", units[x[ok]], units[y[ok]]) >= settings.cosine
        keep[s : s + 20_000] = ok
    return a[keep], b[keep]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a small graph."""
    top = np.arange(n)
    while True:
        new = top.copy()
        np.minimum.at(new, a, top[b])
        np.minimum.at(new, b, top[a])
        new = np.minimum(new, new[new])
        if (new == top).all():
            return top
        top = new


def _answers(settings: CollisionSettings):
    """(key, links, id, root) of each cell's vectors, from rows sorted by cell."""
    def work(rows: pa.Table) -> pa.RecordBatch | None:
        if rows.num_rows < 2:
            return None
        rows = rows.sort_by([("id", "ascending"), ("key", "ascending")]).combine_chunks()
        size, group, cell = (rows[c][0].as_py() for c in ("size", "grp", "cell"))
        copies = rows["copies"].to_numpy()
        a, b = _linked(_units(rows["vector"].to_pylist(), size), rows["block"].to_numpy(), rows["i"][0] != rows["j"][0], size, group, cell, settings)
        if not len(a):
            return None
        links = np.zeros(len(copies), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        has = np.flatnonzero(links)
        found = rows.take(pa.array(has))
        roots = rows["id"].take(pa.array(_roots(len(copies), a, b)[has]))
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (
            found["key"], pa.array(links[has]), found["id"], roots)], names=["key", "links", "id", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if held and (found := work(pa.Table.from_batches(held))) is not None:
                yield found

        for batch in batches:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("label", "size", "grp", "cell", "i", "j"))))
            start = 0
            for at in range(1, len(keys) + 1):
                if at == len(keys) or keys[at] != keys[start]:
                    if keys[start] != key:
                        yield from flush()
                        held, key = [], keys[start]
                    held.append(batch.slice(start, at - start))
                    start = at
        yield from flush()

    return run


def near_vectors(vectors: DataFrame, settings: CollisionSettings = CollisionSettings()) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding, label).

    Vectors are compared only if their labels are equal and not null and their sizes too. Vectors that are null, empty or
    zero, or hold null or non-finite components, are linked with nothing, and so are rows without vec_id, whose component is
    null and who are kept. n_links: other vectors with cosine >= settings.cosine, in double precision; component_id:
    smallest vec_id reachable. Rows that repeat vec_id, label and vector are one vector and get the same result. Rows of one
    vec_id with different vectors or labels are vectors of their own, each with its own links, in one component.

    Equal vectors of a label are one class, which travels once with the number of its members and their smallest vec_id.
    Each projection axis is cut into cells twice as wide as a window is on one side; a class goes to its cell and, from the
    upper half, to the next one too, on `each` axes at once, in `groups` such grids: windows of a single projection would
    bring a good part of all pairs together. Inside a cell the vectors are sorted on a projection and windows around each
    give the candidates; their collisions on all projections are counted, and pairs over the count are
    confirmed. Cells with more than `block` classes are compared block by block. Cells give out counts and one link
    for each class, never their pairs.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    kind, label = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = vectors.select("vec_id", "embedding", "label").mapInArrow(_bytes, f"id {kind}, label {label}, vector binary")
    # length first: no two pairs of vector and label give the same bytes
    named = F.concat(F.encode(F.format_string("%d:", F.length("vector")), "utf-8"), F.col("vector"), F.encode(F.col("label").cast("string"), "utf-8"))
    rows = table(rows.select("id", "label", "vector", F.unhex(F.sha2(named, 256)).alias("key")), "vectors")
    single = rows.where("key is not null").select("id", "key").distinct()
    sizes = single.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    bodies = rows.where("key is not null").groupBy("key").agg(F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = table(bodies.join(sizes, "key"), "vector-classes")

    spread = classes.mapInArrow(_spread(settings), f"label {label}, size int, grp int, cell string, key binary, id {kind}, copies long, vector binary")
    keys = ["label", "size", "grp", "cell"]
    large = table(spread.groupBy(*keys).count().where(F.col("count") > settings.block).select(
        *keys, F.ceil(F.col("count") / settings.block).cast("int").alias("blocks")), "large-cells")
    dealt = spread.join(large, keys, "left").withColumn("block", F.when(
        F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("key"), F.col("blocks"))).cast("int"))
    others = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select(*keys, "key", "id", "copies", "vector", "block", F.explode(others).alias("other")).select(
        *keys, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "id", "copies", "vector")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.repartition(parts, *keys, "i", "j").sortWithinPartitions(*keys, "i", "j").mapInArrow(
        _answers(settings), f"key binary, links long, id {kind}, root {kind}")
    found = table(found, "vector-links")

    # a vec_id with several vectors ties their classes together
    several = single.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    ties = single.join(several, "id").join(sizes.select("key", F.col("id").alias("least")), "key").select(F.col("id").alias("a"), F.col("least").alias("b"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(ties))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    result = classes.select("key", "id", "copies").join(links, "key", "left").join(named, "id", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select(F.col("id").alias("vec_id"), "key").join(result, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
