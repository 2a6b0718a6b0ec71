"""Repeated byte strings across documents: anchors find the spans that can repeat, merged transforms settle them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.arrays import U64, mix, salts, span_hashes, texts
from laneflow.llm.bwt_merge import least_owners
from laneflow.llm.store import small_batches, table


@dataclass(frozen=True)
class RepeatSettings:
    """length: bytes of a string that counts as repeated; gram: bytes of an anchor, a power of two below length; block_bytes:
    text that is worked on at once; part_bytes: text for each part of the exchanges; shard_bytes: of a transform."""

    length: int = 50
    gram: int = 16
    block_bytes: int = 1 << 20
    part_bytes: int = 4 << 20
    shard_bytes: int = 128 << 10


_BYTE = salts(256, seed=29)


# Bytes whose grams are hashed at once: they stay in a core's cache.
_GRAMS_AT_ONCE = 1 << 15


def _grams(flat: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram that begins at each byte."""
    if len(flat) >= 2 * _GRAMS_AT_ONCE:
        return np.concatenate([_grams(flat[at : at + _GRAMS_AT_ONCE + gram - 1], gram) for at in range(0, len(flat) - gram + 1, _GRAMS_AT_ONCE)])
    hashes, step = _BYTE[flat], 1
    with np.errstate(over="ignore"):
        while step < gram:
            hashes = mix(hashes[:-step] * U64(0x9E3779B97F4A7C15) + hashes[step:])
            step *= 2
    return hashes


def spans(flat: np.ndarray, offsets: np.ndarray, settings: RepeatSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start, anchor's place and hash, and the two witnesses of all runs of starts with the same anchor, in order.

    The anchor of a start is the leftmost of the grams with the least hash among those inside the `length` bytes from
    there. Equal strings have equal anchors at equal distances, so strings can be equal only below equal anchors. A
    string also holds at least half of its other bytes on one side of its anchor: so it can stand elsewhere only if the anchor
    with so many bytes on its left, or with so many on its right, does. The hashes of these are the witnesses (rows left, right; 0 where
    the document has no room for one).
    """
    none = (*[np.zeros(0, np.int64)] * 3, np.zeros(0, U64), np.zeros((2, 0), U64))
    if len(flat) < settings.length:
        return none
    hashes = _grams(flat, settings.gram)
    least = (hashes & U64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=U64)
    width, step = settings.length - settings.gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    anchor = (least & U64(0xFFFFFFFF)).astype(np.int64)
    # a start is good if its string ends inside its document
    room = np.diff(offsets) - settings.length + 1
    good = np.zeros(len(anchor) + 1, dtype=np.int8)
    docs = np.flatnonzero(room > 0)
    np.add.at(good, offsets[docs], 1)
    np.add.at(good, offsets[docs] + room[docs], -1)
    good = np.cumsum(good[:-1]) > 0
    change = np.r_[True, anchor[1:] != anchor[:-1]]
    edge = np.zeros(len(anchor) + 1, dtype=bool)
    edge[offsets[offsets <= len(anchor)]] = True
    change |= edge[:-1]
    first = np.flatnonzero(good & (change | ~np.r_[False, good[:-1]]))
    last = np.flatnonzero(good & (np.r_[change[1:], True] | ~np.r_[good[1:], False]))
    own = anchor[first]
    side = min(settings.gram, (settings.length - settings.gram) // 2)
    doc = np.searchsorted(offsets, first, side="right") - 1
    witness = np.zeros((2, len(own)), U64)
    with np.errstate(over="ignore"):
        for row, turn, fits in ((0, -side, own - side >= offsets[doc]), (1, side, own + side + settings.gram <= offsets[doc + 1])):
            at = own[fits]
            witness[row, fits] = mix(hashes[at] * U64(0xD6E8FEB86659FD93) + mix(hashes[at + turn] + U64(row + 1))) | U64(1)
    return first, last, own, hashes[own], witness


def _packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as their differences, in two or four bytes each."""
    steps = np.diff(numbers, prepend=0)
    return (b"\x02" + steps.astype("<u2").tobytes()) if not len(steps) or steps.max() < 1 << 16 else b"\x04" + steps.astype("<u4").tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(body, f"<u{body[0]}", offset=1).astype(np.int64))


def _blocks(settings: RepeatSettings):
    """Rows (batch, doc_ids, sizes, body): documents in blocks, compressed."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, number, held, ids, size = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32, [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                pa.array([pack.compress(b"".join(held))], pa.binary())], names=["batch", "doc_ids", "sizes", "body"])

        for batch in batches:
            flat, offsets = texts(batch.column(1))
            for i, id_ in enumerate(batch.column(0).to_pylist()):
                held.append(flat[offsets[i] : offsets[i + 1]].tobytes()), ids.append(id_)
                size += len(held[-1])
                if size >= settings.block_bytes:
                    yield row()
                    number, held, ids, size = number + 1, [], [], 0
        if held:
            yield row()

    return run


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, dict]]:
    for row in batch.to_pylist():
        body = zstandard.ZstdDecompressor().decompress(row["body"]) if sum(row["sizes"]) else b""
        yield row["batch"], row["doc_ids"], np.frombuffer(body, np.uint8), np.r_[0, np.cumsum(row["sizes"], dtype=np.int64)], row


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (hashes >> U64(64 - (parts.bit_length() - 1))).astype(np.int64) if parts > 1 else np.zeros(len(hashes), np.int64)


def _anchors(settings: RepeatSettings, parts: int):
    """Rows (part, batch, hashes, places): one span for each distinct witness of a block, by part of its hash, and, as
    parts from `parts` on, the spans whose witnesses stand in the block more than once. The top bits of a hash make the part; 32
    low ones go along, enough for the few hundred thousand of a part: a witness kept by chance does no harm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, _, flat, offsets, _ in _opened(batch):
                witness = spans(flat, offsets, settings)[4]
                place = np.tile(np.arange(witness.shape[1]), 2)[witness.ravel() != 0]
                hashes = witness.ravel()[witness.ravel() != 0]
                if not len(hashes):
                    continue
                hashes, first, back, many = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                # by part, and in a part by span
                part, at = _part(hashes, parts), place[first]
                own = np.lexsort((at, part))
                out = []
                for group in np.split(own, np.flatnonzero(np.diff(part[own])) + 1):
                    out.append((int(part[group[0]]), number, hashes[group].view(np.uint8).reshape(-1, 8)[:, 1:5].tobytes(), _packed(at[group])))
                out.append((parts + number % parts, number, b"", _packed(np.unique(place[many[back] > 1]))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["part", "batch", "hashes", "places"])

    return run


def _repeated(rows: pa.Table) -> pa.Table:
    """(batch, places) of the spans with a witness that stands in more than one block."""
    batches, found = rows["batch"].to_pylist(), []
    bodies = [np.frombuffer(x, "<u4") for x in rows["hashes"].to_pylist()]
    if not any(len(x) for x in bodies):
        return rows.select(["batch", "places"])
    hashes = np.concatenate(bodies)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = 0
    for body, places in zip(bodies, rows["places"].to_pylist()):
        found.append(_packed(_unpacked(places)[again[at : at + len(body)]]))
        at += len(body)
    return pa.table({"batch": pa.array(batches, pa.int64()), "places": pa.array(found, pa.binary())})


_CONTENT = [("part", pa.int64()), ("batch", pa.int64()), ("inside", pa.binary()), ("sizes", pa.binary()), ("least", pa.binary()), ("body", pa.binary())]


def _keys(flat: np.ndarray, first: np.ndarray, last: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """A hash of each string and its anchor."""
    with np.errstate(over="ignore"):
        return mix(span_hashes(flat, first, last) ^ (anchors * U64(0x9E3779B97F4A7C15)))


class _Strings:
    """The distinct strings of a block below its kept spans, dealt into parts by their anchor's hash.

    doc, first, last: of every kept span, its document and its bytes; string: which distinct string it holds. Of the distinct
    strings: keys, inside (its anchor's place in it), one (a span that holds it), and the groups of the parts, each in order of key. Computed from the
    block alone, so that a later step finds the same ones again.
    """

    def __init__(self, ids: list, flat: np.ndarray, offsets: np.ndarray, places: list[bytes], settings: RepeatSettings, parts: int):
        first, last, anchor, hashes, _ = spans(flat, offsets, settings)
        keep = np.unique(np.concatenate([np.zeros(0, np.int64), *[_unpacked(x) for x in places]]))
        doc = np.searchsorted(offsets, first[keep], side="right") - 1
        named = np.array([i is not None for i in ids], bool)[doc]
        keep, self.doc = keep[named], doc[named]
        self.first, self.last, hashes = first[keep], last[keep] + settings.length, hashes[keep]
        self.owner = np.array([0 if i is None else i for i in ids], np.int64)[self.doc]
        keys = _keys(flat, self.first, self.last, hashes)
        self.keys, self.one, self.string = np.unique(keys, return_index=True, return_inverse=True)
        self.inside = (anchor[keep] - self.first)[self.one]
        part = _part(hashes[self.one], parts)
        order = np.argsort(part, kind="stable")
        self.groups = {int(part[g[0]]): g for g in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(g)}


def _contents(settings: RepeatSettings, parts: int):
    """Rows of _CONTENT: the distinct strings of a block with the smallest document that holds each, by part of the anchor's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for number, ids, flat, offsets, row in _opened(batch):
                if not row["places"]:
                    continue
                own = _Strings(ids, flat, offsets, row["places"], settings, parts)
                if not own.groups:
                    continue
                least = np.full(len(own.keys), np.iinfo(np.int64).max)
                np.minimum.at(least, own.string, own.owner)
                out = []
                for part, group in own.groups.items():
                    at = own.first[own.one[group]]
                    sizes = own.last[own.one[group]] - at
                    body = flat[np.arange(sizes.sum()) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)]
                    out.append((part, number, own.inside[group].astype("<u2").tobytes(), sizes.astype("<u2").tobytes(), least[group].tobytes(), pack.compress(body.tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), _CONTENT)], names=[c for c, _ in _CONTENT])

    return run


def _classes(keys: np.ndarray, sizes: np.ndarray, begin: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One string of each class of equal strings, and the class of each. Strings meet by key, then their bytes are compared."""
    _, one, back = np.unique(keys, return_index=True, return_inverse=True)
    other = np.flatnonzero((sizes != sizes[one][back]) | (one[back] != np.arange(len(keys))))
    same = sizes[other] == sizes[one][back[other]]
    for some in np.array_split(np.flatnonzero(same), max(1, len(other) // 20_000)):
        n = sizes[other[some]]
        if len(n):
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            equal = body[np.repeat(begin[other[some]], n) + step] == body[np.repeat(begin[one][back[other[some]]], n) + step]
            same[some] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    told: dict[tuple[int, bytes], int] = {}
    for i in other[~same].tolist():  # equal keys of different bytes: hardly ever
        text = (int(keys[i]), body[begin[i] : begin[i] + sizes[i]].tobytes())
        if text not in told:
            told[text] = len(one)
            one = np.append(one, i)
        back[i] = told[text]
    return one, back


def _settled(settings: RepeatSettings):
    """(batch, part, counts, least): of each distinct string of a block the smallest document that holds it, or, where strings
    below its anchor overlap in part, the smallest one for each start (counts: how many numbers)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        read = lambda c, kind: [np.frombuffer(r[c], kind) for r in rows]
        sizes, inside = (np.concatenate(read(c, "<u2")).astype(np.int64) for c in ("sizes", "inside"))
        body, owners = np.concatenate([np.frombuffer(zstandard.decompress(r["body"]), np.uint8) for r in rows]), np.concatenate(read("least", np.int64))
        begin = np.cumsum(sizes) - sizes
        anchors, keys = np.empty(len(sizes), U64), np.empty(len(sizes), U64)
        for some in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(begin >> 20)) + 1):  # about a megabyte at a time
            low, high = begin[some[0]], begin[some[-1]] + sizes[some[-1]]
            anchors[some] = _grams(body[low:high], settings.gram)[begin[some] - low + inside[some]]
            keys[some] = _keys(body[low:high], begin[some] - low, begin[some] + sizes[some] - low, anchors[some])
        one, back = _classes(keys, sizes, begin, body)
        least = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(least, back, owners)
        anchors, sizes, begin = anchors[one], sizes[one], begin[one]
        # strings that are alone below their anchor repeat as a whole or not at all
        _, group, size = np.unique(anchors, return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(size[group] > 1)
        counts = np.ones(len(one), np.int64)
        counts[mixed] = sizes[mixed] - settings.length + 1
        ends = np.cumsum(counts)
        values = np.repeat(least, counts)
        # strings meet below one anchor only: some anchors at a time
        mixed = mixed[np.argsort(group[mixed], kind="stable")]
        head = np.flatnonzero(np.r_[True, group[mixed][1:] != group[mixed][:-1]]) if len(mixed) else mixed
        done = np.cumsum(sizes[mixed]) // (4 * settings.shard_bytes)
        some = np.repeat(done[head], np.diff(np.r_[head, len(mixed)]))
        for now in np.unique(some):
            few = mixed[some == now]
            own = sizes[few]
            flat = body[np.arange(own.sum()) + np.repeat(begin[few] - (np.cumsum(own) - own), own)]
            table_ = least_owners(flat, own, least[few], settings.length, settings.shard_bytes)
            n = counts[few]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            values[np.repeat(ends[few] - n, n) + step] = table_[np.repeat(np.arange(len(few)), n), step]
        pack, at, out = zstandard.ZstdCompressor(level=3), 0, []
        for r in rows:
            mine = back[at : at + len(r["sizes"]) // 2]
            at += len(mine)
            n = counts[mine]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((r["batch"], r["part"], n.astype("<u2").tobytes(), pack.compress(values[np.repeat(ends[mine] - n, n) + step].tobytes())))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["batch", "part", "counts", "least"])

    return run


def _covered(own: _Strings, found: list[dict], settings: RepeatSettings) -> tuple[np.ndarray, np.ndarray]:
    """Where what is removed below the kept spans of a block begins and ends."""
    counts, first = np.zeros(len(own.keys), np.int64), np.zeros(len(own.keys), np.int64)
    values, size = [], 0
    for row in found:
        group = own.groups[row["part"]]
        n = np.frombuffer(row["counts"], "<u2").astype(np.int64)
        counts[group], first[group] = n, size + np.cumsum(n) - n
        values.append(np.frombuffer(zstandard.decompress(row["least"]), np.int64))
        size += len(values[-1])
    values = np.concatenate(values)
    low, high = [], []
    starts = own.last - own.first - settings.length + 1
    for at in np.array_split(np.arange(len(own.string)), max(1, len(own.string) // 20_000)):
        n, of = counts[own.string[at]], own.string[at]
        step = np.arange(int(starts[at].max(initial=1)))
        here = np.minimum(step, (n - 1)[:, None])
        gone = (values[first[of][:, None] + here] < own.owner[at][:, None]) & (step < starts[at][:, None])
        has = gone.any(axis=1)
        # starts of a span lie closer than a string is long: what they cover hangs together
        low.append((own.first[at] + gone.argmax(axis=1))[has])
        high.append((own.first[at] + gone.shape[1] - 1 - gone[:, ::-1].argmax(axis=1) + settings.length)[has])
    return np.concatenate(low), np.concatenate(high)


def _removed(settings: RepeatSettings, parts: int):
    """The documents of each block with what is removed from them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, flat, offsets, row in _opened(batch):
                yield _answer(ids, flat, offsets, row, settings, parts)

    return run


def _answer(ids: list, flat: np.ndarray, offsets: np.ndarray, row: dict, settings: RepeatSettings, parts: int) -> pa.RecordBatch:
    cover = np.zeros(len(flat) + 1, dtype=np.int32)
    if row["found"]:
        low, high = _covered(_Strings(ids, flat, offsets, row["places"], settings, parts), row["found"], settings)
        np.add.at(cover, low, 1)
        np.add.at(cover, high, -1)
    gone = np.cumsum(cover[:-1]) > 0
    out, kept = [], []
    for a, b in zip(offsets, offsets[1:]):
        own = gone[a:b]
        turns = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8))).reshape(-1, 2)
        out.append([{"start": int(x), "end": int(y)} for x, y in turns])
        kept.append(flat[a:b][~own].tobytes())
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def repeated_bytes(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """doc_id, n_bytes, spans and kept of every document.

    spans: maximal byte ranges [start, end) covered by strings of `length` bytes that also start in a document with a
    smaller doc_id; kept: the bytes outside. Null text is empty; texts shorter than `length` lose nothing, and neither
    do rows without doc_id, which no other row is compared with. Rows that repeat a doc_id don't touch each other.

    1. Documents go into compressed blocks. 2. Every start of a string belongs to an anchor; spans whose witnesses stand once
    only, in all blocks, are dropped. 3. The distinct strings of each block below the others meet by anchor, each with the
    smallest document of its block: equal ones, byte by byte, become one class. Classes that share an anchor with others are cut
    into shards; the shards' transforms are merged, and the repeated intervals of the merged order give each start its
    smallest document. 4. Blocks get back the smallest documents of their distinct strings and judge what stands where
    by themselves. So a hot passage, or a run of one byte, weighs as much as the number of blocks that hold it, however often
    it stands there; parts grow in number with the text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 8
    while parts * settings.part_bytes < size:
        parts *= 2
    blocks = table(rows.mapInArrow(_blocks(settings), "batch long, doc_ids array<long>, sizes array<long>, body binary"), "text-blocks")
    anchors = blocks.mapInArrow(_anchors(settings, parts), "part long, batch long, hashes binary, places binary")
    places = table(anchors.groupBy("part").applyInArrow(_repeated, "batch long, places binary").groupBy("batch").agg(F.collect_list("places").alias("places")), "places")
    schema = ", ".join(f"{c} {'long' if t == pa.int64() else 'binary'}" for c, t in _CONTENT)
    named = blocks.join(places, "batch", "left")
    # the same rows as in the last step, so that blocks and places are exchanged once for both
    contents = named.mapInArrow(_contents(settings, parts), schema)
    found = contents.groupBy("part").applyInArrow(_settled(settings), "batch long, part long, counts binary, least binary").groupBy("batch").agg(
        F.collect_list(F.struct("part", "counts", "least")).alias("found"))
    return named.join(found, "batch", "left").mapInArrow(
        _removed(settings, parts), "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def digest(repeats: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of `repeated_bytes`."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeats.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
