"""Near-duplicate documents: banded MinHash, odd sketches to judge candidates, exact sets to confirm them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import exp, log, sqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.arrays import BLANKS, LOWER, U64, mix, pieces, salts, span_hashes, word_spans
from laneflow.llm.links import components
from laneflow.llm.store import may_hold, small_batches, table


@dataclass(frozen=True)
class NearSettings:
    """words: of a shingle; percent: least similarity; bands x rows: MinHash samples (a pair at 80 % similarity shares no
    band in 3 of 100,000 cases, at 85 % in 2 of 10 million); bits: of an odd sketch; deviations: how far below the least
    similarity, in standard deviations, a sketch may put a pair that is still confirmed; small: size up to which a
    bucket gives all its pairs at once; block: rows of a bucket that one step compares."""

    words: int = 3
    percent: int = 85
    bands: int = 26
    rows: int = 5
    bits: int = 512
    deviations: float = 5.0
    small: int = 24
    block: int = 256

    @property
    def most_bits(self) -> int:
        """Largest population count of the XOR of two sketches that may still belong to a link.

        Of n samples a link at the least similarity s has n(1 - s) unequal on average; each unequal sample flips two
        bits at random, so that d of them leave bits/2 * (1 - exp(-4 d / bits)) odd.
        """
        n, s = self.bands * self.rows, self.percent / 100
        unequal = min(n, n * (1 - s) + self.deviations * sqrt(n * s * (1 - s)))
        odd = self.bits / 2 * (1 - exp(-4 * unequal / self.bits))
        return int(odd + 2 * sqrt(odd))


def estimate(bits_apart: float, settings: NearSettings = NearSettings()) -> float:
    """Similarity that a population count speaks for."""
    n = settings.bands * settings.rows
    share = min(bits_apart / (settings.bits / 2), 0.999999)
    return max(0.0, 1 + settings.bits / (4 * n) * log(1 - share))


def _shingles(flat: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The distinct shingles of each row, as sorted 64-bit hashes."""
    flat = LOWER[flat]
    starts, ends, row = word_spans(flat, offsets, BLANKS)
    hashes = span_hashes(flat, starts, ends)
    sizes = np.bincount(row, minlength=len(offsets) - 1)
    mixed = np.zeros(len(hashes), dtype=U64)
    with np.errstate(over="ignore"):
        for j, salt in enumerate(salts(words, seed=3)):
            if j < len(hashes):
                mixed[: len(hashes) - j] += mix(hashes[j:] * salt)
        out, at = [], 0
        for size in sizes:
            if size >= words:
                own = mix(mixed[at : at + size - words + 1])
            elif size:  # fewer words: the whole sequence
                own = np.zeros(1, dtype=U64)
                for j, salt in enumerate(salts(words, seed=5)[:size]):
                    own += mix(hashes[at + j : at + j + 1] * salt)
                own = mix(own + U64(size))
            else:
                own = np.zeros(0, dtype=U64)
            out.append(np.unique(own))
            at += size
    return out


def features(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (hash of the set), bands (keys), sketch of all documents."""
    small_batches(docs.sparkSession)
    n, rows = settings.bands * settings.rows, settings.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, shift = ((salts(n, seed=s) >> U64(32)).astype(np.uint32)[:, None] | np.uint32(1) for s in (17, 19))
        lane = salts(n, seed=23)
        for batch, flat, offsets in pieces(batches):
            sets = _shingles(flat, offsets, settings.words)
            low = np.zeros((len(sets), n), dtype=np.uint32)
            whole = np.zeros((len(sets), 2), dtype=U64)
            with np.errstate(over="ignore"):
                for i, own in enumerate(sets):
                    if not len(own):
                        continue
                    short = (own >> U64(32)).astype(np.uint32)
                    low[i] = np.min([(short[at : at + 4096] * turn + shift).min(axis=1) for at in range(0, len(short), 4096)], axis=0)
                    whole[i] = own.sum(dtype=U64), mix(own).sum(dtype=U64)
                wide = mix(low.astype(U64) + lane)
                keys = np.zeros((len(sets), settings.bands), dtype=U64)
                for j in range(rows):
                    keys = mix(keys * U64(31) + wide[:, j::rows])
                bit = (wide % U64(settings.bits)).astype(np.int64) + np.arange(len(sets))[:, None] * settings.bits
            odd = np.bincount(bit.ravel(), minlength=len(sets) * settings.bits).reshape(len(sets), -1) & 1
            sketch = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
            lists = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array(whole[:, 0].view(np.int64)), pa.array(whole[:, 1].view(np.int64)), lists(keys), lists(sketch)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>")


def _bodies(docs: DataFrame) -> DataFrame:
    """id and its whole text, compressed: a third of what its set of hashes would weigh."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch, flat, offsets in pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pack.compress(flat[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])], pa.binary())], names=["id", "body"])

    return docs.mapInArrow(run, f"id {docs.schema['doc_id'].dataType.simpleString()}, body binary")


def _set_of(body: bytes, words: int) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(body), np.uint8)
    return _shingles(flat, np.array([0, len(flat)]), words)[0]


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, bodies: DataFrame, settings: NearSettings) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(_set_of(x.as_py(), settings.words), _set_of(y.as_py(), settings.words), settings.percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wide = pairs.join(_texts_of(bodies, pairs, "a", "left"), "a").join(_texts_of(bodies, pairs, "b", "right"), "b").select("a", "b", "left", "right")
    return wide.mapInArrow(run, pairs.select("a", "b").schema)


def _texts_of(bodies: DataFrame, rows: DataFrame, id_: str, name: str = "body") -> DataFrame:
    """One text for each id in rows: (id_, name). Only texts that rows ask for travel, and once: where ids are made unique, the join finds them."""
    asked, _ = may_hold(bodies, "id", rows, id_)
    return asked.groupBy(F.col("id").alias(id_)).agg(F.min("body").alias(name))


def _mixed_links(members: DataFrame, bodies: DataFrame, settings: NearSettings) -> DataFrame:
    """Components (a, b) that share large buckets and have a confirmed link, no more rows of a step than join its components.

    members: crowd (the component of a large bucket's first; all large buckets whose first is in that component are one crowd),
    id, component, n_shingles, sketch. bodies: the compressed texts. Rows of the crowd's own component never meet each other;
    all others meet everything, block by block, so no step holds more than two blocks, and none gives out pairs. Texts are
    opened only where sketches are close enough.
    """
    minor = F.col("component") != F.col("crowd")
    sizes = members.groupBy("crowd").agg(
        F.ceil(F.count_if(minor) / settings.block).cast("int").alias("minors"),
        F.ceil(F.count_if(~minor) / settings.block).cast("int").alias("majors"))
    own = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    blocks = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = own(F.col("minors"))
    among = F.transform(blocks("minors"), lambda j: cell(0, F.least(mine, j), F.greatest(mine, j)))
    across = F.transform(blocks("majors"), lambda j: cell(1, mine, j))
    other = F.transform(blocks("minors"), lambda i: cell(1, i, own(F.col("majors"))))
    cells = members.join(sizes, "crowd").withColumn("cells", F.when(minor, F.concat(among, across)).otherwise(other))
    texts = _texts_of(bodies, members, "id")
    copies = cells.join(texts, "id").select("crowd", "id", "component", "sketch", "n_shingles", "body", F.explode("cells").alias("cell"))
    most = settings.most_bits

    def links(rows: pa.Table) -> pa.Table:
        sketch = np.stack(rows["sketch"].to_pylist()).astype(np.int64).view(U64)
        sizes, bodies, sets = rows["n_shingles"].to_numpy(), rows["body"], {}

        def own_set(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = _set_of(bodies[i].as_py(), settings.words)
            return sets[i]

        names, component = np.unique(rows["component"].to_numpy(), return_inverse=True)
        whose = component.copy()
        a, b = [], []
        for i in range(1, rows.num_rows):
            apart = np.bitwise_count(sketch[:i] ^ sketch[i]).sum(axis=1)
            fits = 100 * np.minimum(sizes[:i], sizes[i]) >= settings.percent * np.maximum(sizes[:i], sizes[i])
            for j in np.flatnonzero((apart <= most) & fits & (component[:i] != component[i])).tolist():
                if component[i] != component[j] and _similar(own_set(i), own_set(j), settings.percent):
                    component[component == component[i]] = component[j]
                    a.append(names[whose[i]]), b.append(names[whose[j]])
        return pa.table({c: pa.array(x, rows["id"].type) for c, x in (("a", a), ("b", b))})

    kind = members.schema["id"].dataType.simpleString()
    return copies.groupBy("crowd", "cell").applyInArrow(links, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, settings: NearSettings = NearSettings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Words are `[^\\x20\\x09-\\x0D]+` in lower case (A-Z only); a document's set holds its distinct shingles, or its whole
    sequence if it has fewer words. Null, empty and blank texts have no set and are linked with nothing. component_id:
    smallest doc_id reachable by links; kept: the document is that one. Rows that repeat a doc_id with its text
    get the same answer; rows without doc_id are linked with nothing and kept.

    1. Documents with equal sets are one class, stood for by the smallest doc_id. 2. Classes that share a band are
    candidates; small buckets give all pairs, large ones the pairs with their first. 3. Odd sketches drop pairs that
    are surely too far apart. 4. Each class is first confirmed against its smallest candidate only, and components are
    formed. 5. Candidates in different components still are all confirmed, and members of large
    buckets with several components meet block by block, so no link between components is lost.
    """
    marked = table(features(docs, settings), "features")
    full = marked.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("first"))
    classes = table(classes, "classes")
    stands = full.join(classes.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), "n_shingles", "bands", "sketch").dropDuplicates(["id"])
    stands = table(stands, "stands")
    keyed = stands.select("id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("n > 1")
    filled = table(keyed.join(buckets, "key"), "buckets")
    small = filled.where(F.col("n") <= settings.small).select("key", "id")
    pairs = small.withColumnRenamed("id", "a").join(small.withColumnRenamed("id", "b"), "key").where("a > b").select("a", "b").unionByName(
        filled.where((F.col("n") > settings.small) & (F.col("id") != F.col("low"))).select(F.col("id").alias("a"), F.col("low").alias("b"))).distinct()
    sketches = stands.select("id", "n_shingles", "sketch")
    apart = F.aggregate(F.zip_with("left", "right", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("left")), "a").join(
        sketches.select(F.col("id").alias("b"), F.col("sketch").alias("right")), "b").where(apart <= settings.most_bits).select("a", "b")
    near = table(near, "near")
    large = filled.where(F.col("n") > settings.small)
    wanted = near.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(large.select(F.col("id").alias("doc_id"))).distinct()
    # texts of some other ids come along by chance; they cost a little room, where a join would send all texts
    bodies = table(_bodies(may_hold(docs.select("doc_id", "text"), "doc_id", wanted, "doc_id")[0]), "bodies")
    first = table(_confirmed(table(near.groupBy("a").agg(F.min("b").alias("b")), "nearest"), bodies, settings), "confirmed")
    found = components(first)
    named = lambda df, c, to: df.join(found.select(F.col("id").alias(c), F.col("component_id").alias("_to")), c, "left").withColumn(to, F.coalesce("_to", c)).drop("_to")
    rest = table(named(named(near, "a", "ca"), "b", "cb").where("ca != cb").select("a", "b"), "rest")
    crowds = named(named(large.select("key", "id", "low"), "id", "component"), "low", "crowd").select("key", "id", "component", "crowd")
    crowds = table(crowds, "crowds")
    uneven = crowds.where("component != crowd").select("key").distinct()
    members = crowds.join(uneven, "key", "left_semi").select("crowd", "id", "component").distinct()
    members = table(members.join(sketches, "id"), "members")
    second = []
    if not rest.isEmpty():
        second.append(named(named(table(_confirmed(rest, bodies, settings), "confirmed-rest"), "a", "ca"), "b", "cb").select("ca", "cb"))
    if not members.isEmpty():
        second.append(_mixed_links(members, bodies, settings).toDF("ca", "cb"))
    out = marked.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b", "n_shingles"], "left").join(
        found.withColumnRenamed("id", "first"), "first", "left").withColumn("component_id", F.coalesce("component_id", "first"))
    if second:
        merged = components(reduce(DataFrame.unionByName, second), "ca", "cb")
        out = out.withColumnRenamed("component_id", "ca").join(merged.withColumnRenamed("id", "ca"), "ca", "left").withColumn(
            "component_id", F.coalesce("component_id", "ca"))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, settings: NearSettings = NearSettings(words=5, percent=80)) -> DataFrame:
    """docs without the documents that are near-duplicates of one with a smaller id; all columns stay."""
    gone = table(near_duplicates(docs.select("doc_id", "text"), settings).where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    asked, clear = may_hold(docs, "doc_id", gone, "_gone")
    return clear.unionByName(asked.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti"))
