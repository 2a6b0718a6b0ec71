"""Documents as token pieces, and pieces as packed sequences: written matrices, and certified repacking."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.arrays import pieces as text_pieces
from laneflow.llm.packing import best_fit, lower_bound
from laneflow.llm.store import small_batches, table
from laneflow.llm.tokens import encoder


@dataclass(frozen=True)
class PackSettings:
    """vocabulary: path of the tokenizer file, the same on all machines; size: tokens of a sequence; end_id: closes
    each document; group: pieces that one task packs; shard_tokens: tokens that one matrix is packed from; rounds: of
    exchange at most."""

    vocabulary: str
    size: int = 2048
    end_id: int = 0
    group: int = 100_000
    shard_tokens: int = 2 << 20
    rounds: int = 8


def _documents(batches: Iterator[pa.RecordBatch], settings: PackSettings) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches with the ids of each row, its end id included; null text is empty."""
    own = encoder(settings.vocabulary)
    for batch, flat, offsets in text_pieces(batches):
        ids, at = own.encode(flat, offsets)
        yield batch, [np.append(ids[at[i] : at[i + 1]], np.uint32(settings.end_id)).astype("<u4") for i in range(batch.num_rows)]


def token_pieces(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces: a document, or its cuts of `size` tokens, counted from its end: the first may be
    shorter."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, documents in _documents(batches, settings):
            row, start, length, crc, piece = [], [], [], [], []
            for i, ids in enumerate(documents):
                head = len(ids) % settings.size or settings.size
                for p, (at, end) in enumerate(zip([0, *range(head, len(ids), settings.size)], range(head, len(ids) + 1, settings.size))):
                    part = ids[at:end]
                    row.append(i), piece.append(p), start.append(at), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def _pack(settings: PackSettings, round_: int):
    """Packs one group of pieces. A group keeps its old bins if the new ones are not fewer."""
    def run(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy().astype(np.int64)
        order = np.lexsort((group["start"].to_numpy(), group["doc_id"].fill_null(-1).to_numpy(), -lengths)) if pa.types.is_integer(group["doc_id"].type) else np.argsort(-lengths, kind="stable")
        group, lengths = group.take(pa.array(order)), lengths[order]
        bins, offsets = best_fit(lengths, settings.size)
        old, back = np.unique(group["sequence_id"].to_numpy(), return_inverse=True)
        count, bound = int(bins.max(initial=-1)) + 1, lower_bound(lengths, settings.size)
        part = int(group["part"][0].as_py())
        if round_ and count >= len(old):
            bins, offsets, count, ids = back, group["offset"].to_numpy(), len(old), group["sequence_id"].to_numpy()
        else:
            ids = (round_ << 54) + (part << 20) + bins
        certified = count <= bound
        full = np.bincount(bins, weights=lengths, minlength=count)[bins] >= settings.size
        new = {"sequence_id": pa.array(ids, pa.int64()), "offset": pa.array(offsets, pa.int64()),
               "certified": pa.array(np.full(len(ids), certified)), "settled": pa.array(full | certified)}
        return pa.table({c: new.get(c, group[c]) for c in group.column_names})

    return run


def repack(pieces: DataFrame, settings: PackSettings) -> DataFrame:
    """Adds sequence_id, offset and certified to pieces (doc_id, start, length and others).

    Groups of pieces are packed by best fit decreasing, each in a task. A group whose bins are as many as its lower bound
    is certified and done; in the others the full bins are done, and the rest goes on: its bins are dealt anew over
    fewer groups, so that pieces of different groups meet, and packed again. The last round is one group, of `group`
    pieces at most, or the one after `rounds`. Bins never become more. No pieces: no rows.
    """
    schema = pieces.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                           F.lit(False).alias("certified"), F.lit(False).alias("settled")).schema
    todo, done = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "certified": F.lit(False), "settled": F.lit(False)}), []
    dealt = F.xxhash64(F.monotonically_increasing_id())  # not by id: many rows may have none, or the same
    for round_ in range(settings.rounds):
        parts = max(1, -(-todo.count() // settings.group))
        packed = todo.withColumn("part", F.pmod(dealt, F.lit(parts)).cast("int")).select(*schema.names).groupBy("part").applyInArrow(_pack(settings, round_), schema)
        packed = table(packed, f"packed-{round_}")
        done.append(packed.where("settled"))
        todo = packed.where("not settled").drop("part")
        if parts == 1 or todo.isEmpty():
            break
        dealt = F.xxhash64("sequence_id")  # a bin moves as a whole
    out = todo.select(*pieces.columns, "sequence_id", "offset", "certified")
    for rows in done:
        out = out.unionByName(rows.select(*out.columns))
    return out


def certified_packing(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """All pieces of all documents with their places in sequences of `size` tokens.

    Null and empty texts are one piece with the end id alone. Rows that repeat are packed as often as they stand there.
    """
    return repack(table(token_pieces(docs, settings), "pieces"), settings)


def packed_matrices(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """Rows of packed id matrices: shard, row, input_ids, cu_seqlens, resets, doc_ids, pieces, starts.

    Every task packs shards of about `shard_tokens` tokens by best fit decreasing. input_ids: `size` little-endian unsigned
    32-bit ids, filled up with the end id; cu_seqlens: 0 and the ends of the segments, filler not counted; resets: where
    position ids begin again at 0 (the segment starts, and the filler's if there is one); doc_ids, pieces and
    starts: the document of each segment, the number of the cut, and the document's ids before it. Null and empty texts
    are one end id. No documents: no rows. shard: the partition and a running number in it.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, int, int, np.ndarray]] = []
        shard = tokens = 0
        for batch, documents in _documents(batches, settings):
            names = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for name, ids in zip(names, documents):
                for p, at in enumerate(range(0, len(ids), settings.size)):
                    held.append((name, p, at, ids[at : at + settings.size]))
                    tokens += len(held[-1][3])
                    if tokens >= settings.shard_tokens:
                        yield _matrix(held, shard, batch.schema.field("doc_id").type, settings)
                        held, tokens, shard = [], 0, shard + 1
            last = batch.schema.field("doc_id").type
        if held:
            yield _matrix(held, shard, last, settings)

    return docs.select("doc_id", "text").mapInArrow(run, "shard long, row int, input_ids binary, cu_seqlens array<int>, resets array<int>, "
                                                    f"doc_ids array<{kind}>, pieces array<int>, starts array<long>")


def _matrix(held: list, shard: int, kind: pa.DataType, settings: PackSettings) -> pa.RecordBatch:
    from pyspark import TaskContext

    lengths = np.array([len(x[3]) for x in held], np.int64)
    bins, offsets = best_fit(lengths, settings.size)
    matrix = np.full((int(bins.max()) + 1, settings.size), settings.end_id, dtype="<u4")
    order = np.lexsort((offsets, bins))
    segments: list[list[int]] = [[] for _ in matrix]
    for i in order.tolist():
        matrix[bins[i], offsets[i] : offsets[i] + lengths[i]] = held[i][3]
        segments[bins[i]].append(i)
    ends = [[0, *np.cumsum(lengths[own]).tolist()] for own in segments]
    first = (TaskContext.get().partitionId() << 32) + shard
    return pa.RecordBatch.from_arrays([
        pa.array([first] * len(matrix), pa.int64()), pa.array(range(len(matrix)), pa.int32()), pa.array([x.tobytes() for x in matrix], pa.binary()),
        pa.array(ends, pa.list_(pa.int32())), pa.array([e if e[-1] < settings.size else e[:-1] for e in ends], pa.list_(pa.int32())),
        pa.array([[held[i][0] for i in own] for own in segments], pa.list_(kind)), pa.array([[held[i][1] for i in own] for own in segments], pa.list_(pa.int32())),
        pa.array([[held[i][2] for i in own] for own in segments], pa.list_(pa.int64()))],
        names=["shard", "row", "input_ids", "cu_seqlens", "resets", "doc_ids", "pieces", "starts"])


def write_matrices(docs: DataFrame, path: str, settings: PackSettings) -> None:
    """Writes the packed matrices below path, in Parquet files; a new run replaces them."""
    packed_matrices(docs, settings).write.mode("overwrite").option("compression", "zstd").parquet(path)
