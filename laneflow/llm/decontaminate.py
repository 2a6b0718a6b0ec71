"""Benchmark phrases in training documents, found with an FM-index of each shard of the documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.arrays import LOWER, NON_WORD, pieces, span_hashes, texts, word_spans
from laneflow.llm.fm_index import FmIndex
from laneflow.llm.store import small_batches, table


@dataclass(frozen=True)
class PhraseSettings:
    """window: words of a phrase; block_bytes: benchmark text that is sent to the tasks at once; shard_bytes: text
    of one index."""

    window: int = 10
    block_bytes: int = 8 << 20
    shard_bytes: int = 2 << 20


class Phrases:
    """The distinct windows of some benchmark items, as rows of word numbers; words are numbered from 1."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.items = [i for i, _ in items]
        flat, offsets = texts(pa.array([t for _, t in items], pa.string()))
        flat = LOWER[flat]
        starts, ends, row = word_spans(flat, offsets, NON_WORD)
        hashes = span_hashes(flat, starts, ends)
        self.words = np.unique(hashes)
        numbers = np.searchsorted(self.words, hashes) + 1
        found: dict[bytes, set[int]] = {}
        sizes = np.bincount(row, minlength=len(items))
        for item, (end, size) in enumerate(zip(np.cumsum(sizes), sizes)):
            own = numbers[end - size : end].astype(np.int32)
            for at in range(max(1, size - window + 1) if size else 0):
                found.setdefault(own[at : at + window].tobytes(), set()).add(item)
        by_size: dict[int, list[bytes]] = {}
        for key in found:
            by_size.setdefault(len(key) // 4, []).append(key)
        self.tables = [(np.frombuffer(b"".join(keys), np.int32).reshape(-1, size).astype(np.int64), [sorted(found[k]) for k in keys]) for size, keys in sorted(by_size.items())]
        self.shortest = min(by_size, default=1)


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of bounded size; always one at least."""
    block, size = [], 0
    for r in benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator():
        block.append((r.i, r.text))
        size += len(r.text) * 2
        if size >= most:
            yield block
            block, size = [], 0
    if block or not size:
        yield block


def _occurrences(numbers: np.ndarray, row: np.ndarray, phrases: Phrases, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, list]]:
    """First word, phrase, length and items of all places of the phrases in a shard.

    numbers: of the shard's words, 0 for those in no phrase. Runs of such words become one 0, and a 0 stands
    between rows, so the index holds only what a phrase can meet.
    """
    n = len(numbers)
    zero = numbers == 0
    stays = np.ones(n, dtype=bool)
    stays[1:] = ~(zero[1:] & zero[:-1])
    # a run of known words shorter than every phrase holds none
    runs = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | zero[1:] | zero[:-1]])
    short = np.repeat(np.diff(np.r_[runs, n]) < phrases.shortest, np.diff(np.r_[runs, n]))
    stays &= ~(short & ~zero)
    words = np.flatnonzero(stays)
    if not len(words) or not phrases.tables:
        return
    breaks = np.r_[False, (row[words[1:]] != row[words[:-1]]) | (words[1:] != words[:-1] + 1)]
    at = np.arange(len(words)) + np.cumsum(breaks) + 1
    symbols, origin = np.zeros(at[-1] + 2, dtype=np.int32), np.zeros(at[-1] + 2, dtype=np.int64)
    symbols[at], origin[at] = numbers[words], words
    index = FmIndex(symbols, len(phrases.words), depth)
    for table_, items in phrases.tables:
        low, high = index.search(table_)
        many = high - low
        which = np.repeat(np.arange(len(low)), many)
        if len(which):
            places = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]
            yield origin[index.locate(places)], which, table_.shape[1], items


def search(docs: DataFrame, benchmark: DataFrame, settings: PhraseSettings = PhraseSettings(), then=None) -> DataFrame:
    """Adds n_words, n_hit, items and spans to docs. then: what the tasks do with the batches after the last search, in the same workers.

    n_hit: words inside an occurrence of a window of a benchmark item; items: ids of items with such windows, as
    strings, distinct; spans: merged byte ranges [start, end) of the hit words in the UTF-8 text, for removal. A word is
    `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in lower case (A-Z only). Null and wordless texts: no words, no hits. Null
    item ids or texts give no windows; rows with the same item id count as one item. No benchmark: no hits.
    """
    spark, new = docs.sparkSession, ["n_words", "n_hit", "items", "spans"]
    small_batches(spark)
    found = docs.drop(*new).withColumns({
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
        "spans": F.array().cast("array<struct<start:bigint,end:bigint>>")})
    blocks, place = _blocks(benchmark, settings.block_bytes), 0
    block = next(blocks, None)
    while block is not None:
        sent, block = spark.sparkContext.broadcast(Phrases(block, settings.window)), next(blocks, None)
        run = _searcher(sent, settings, then if block is None else None)
        found = (table(found, "searched") if place else found).mapInArrow(run, found.schema)
        place += 1
    return found


def _searcher(sent, settings: PhraseSettings, then=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for batch, flat, offsets in pieces(batches, most=settings.shard_bytes):
            flat = LOWER[flat]
            starts, ends, row = word_spans(flat, offsets, NON_WORD)
            n = len(starts)
            numbers = np.zeros(n, dtype=np.int32)
            if n and len(phrases.words):
                hashes = span_hashes(flat, starts, ends)
                place = np.minimum(np.searchsorted(phrases.words, hashes), len(phrases.words) - 1)
                numbers = np.where(phrases.words[place] == hashes, place + 1, 0).astype(np.int32)
            cover = np.zeros(n + 1, dtype=np.int64)
            old = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("items", "spans")}
            for i, spans in enumerate(old["spans"]):  # of an earlier block
                for s in spans:
                    np.add.at(cover, np.searchsorted(starts, [offsets[i] + s["start"], offsets[i] + s["end"]]), [1, -1])
            items = [set(x) for x in old["items"]]
            if n:
                for first, which, size, owners in _occurrences(numbers, row, phrases, settings.window):
                    np.add.at(cover, first, 1)
                    np.add.at(cover, first + size, -1)
                    for pair in np.unique(row[first] * len(owners) + which):
                        items[pair // len(owners)].update(phrases.items[i] for i in owners[pair % len(owners)])
            hit = np.cumsum(cover[:n]) > 0
            opens = np.flatnonzero(hit & ~np.r_[False, hit[:-1] & (row[1:] == row[:-1])]) if n else np.zeros(0, int)
            closes = np.flatnonzero(hit & ~np.r_[hit[1:] & (row[1:] == row[:-1]), False]) if n else np.zeros(0, int)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for a, b in zip(opens, closes):
                spans[row[a]].append({"start": int(starts[a] - offsets[row[a]]), "end": int(ends[b] - offsets[row[a]])})
            new = {
                "n_words": pa.array(np.bincount(row, minlength=batch.num_rows).astype(np.int64)),
                "n_hit": pa.array(np.bincount(row[hit], minlength=batch.num_rows).astype(np.int64)),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], names=batch.schema.names)

    return run if then is None else lambda batches: then(run(batches))


def cutter(filler: str = "\n"):
    """Takes the spans of batches out of their texts, a filler in place of each; other columns stay.

    Null text stays null; rows without spans keep their text byte for byte.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                if text is not None and spans:
                    body, kept, last = text.encode(), [], 0
                    for s in spans:
                        kept.append(body[last : s["start"]])
                        last = s["end"]
                    text = filler.encode().join([*kept, body[last:]]).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return run


def cut(docs: DataFrame, filler: str = "\n") -> DataFrame:
    """docs (with spans) after `cutter`."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(cutter(filler), docs.schema)


def remove(docs: DataFrame, benchmark: DataFrame, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """docs without the benchmark's windows in their texts, and n_chars (if there) to match; other columns stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = search(docs.select("text", whole), benchmark, settings, cutter())
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(F.col("n_hit") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def contamination(docs: DataFrame, benchmark: DataFrame, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = search(docs.select("doc_id", "text"), benchmark, settings)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
