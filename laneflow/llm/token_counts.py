"""Token counts of whole texts: each distinct pre-token is counted once, and documents add up what they hold of it."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.arrays import pieces
from laneflow.llm.store import small_batches, table


@dataclass(frozen=True)
class CountSettings:
    """vocabulary: path of a sentencepiece model, the same on all machines; limit: tokens over which a document is marked;
    block_bytes: text whose documents share one list of pre-tokens (a longer document has a list of its own)."""

    vocabulary: str
    limit: int = 4096
    block_bytes: int = 32 << 20


class PreTokens:
    """Cuts texts into pre-tokens and counts the pieces of one.

    A text is cut between two characters that no piece of the vocabulary has side by side: each merge makes a piece, so
    none reaches over such a cut, and the pieces of a text are those of its pre-tokens. The blank that the library
    puts before a text belongs to its first pre-token. A line break stands in no piece, so a pre-token behind one has
    the same pieces as inside its text. Only models that change nothing but blanks are taken.
    """

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "a  b\tc Ａﬁ "
        own = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        words = [x for x in map(model.id_to_piece, own) if len(x) > 1]
        if model.normalize(probe) != "▁" + probe.replace(" ", "▁") or any("\n" in x for x in words):
            raise ValueError("the model changes texts, or has pieces with line breaks")
        letters = sorted(set("".join(words)))
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.classes[32] = self.classes[0x2581]
        self.together = np.zeros((len(letters) + 1,) * 2, bool)
        for x in words:
            own = self.classes[[ord(c) for c in x]]
            self.together[own[:-1], own[1:]] = True
        self.before = len(model.encode("\n"))

    def split(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pre-tokens of all rows in their order, and the row of each. flat: valid UTF-8; empty rows have none."""
        sizes = np.diff(offsets)
        starts = offsets[:-1][sizes > 0]
        flat = np.insert(flat, starts, 32)  # the blank before each text
        first = starts + np.arange(len(starts))
        head = np.flatnonzero((flat & 0xC0) != 0x80)
        points = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), np.uint32)
        own = self.classes[points]
        cut = np.ones(len(own), bool)
        cut[1:] = ~self.together[own[:-1], own[1:]]
        cut[np.searchsorted(head, first)] = True
        places = head[cut]
        words = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(np.append(places, len(flat)).astype(np.int64)), pa.py_buffer(flat)])
        return words.dictionary_encode(), np.flatnonzero(sizes)[np.searchsorted(first, places, side="right") - 1]

    def count(self, words: list[bytes]) -> list[int]:
        """The number of pieces of each pre-token."""
        return [len(x) - self.before for x in self.model.encode(["\n" + w.decode() for w in words], num_threads=1)]


def pre_tokens(path: str) -> PreTokens:
    """This process's cutter for a model file: tasks that follow each other share it."""
    held = sys.modules.setdefault("_laneflow_pre_tokens", types.ModuleType("_laneflow_pre_tokens")).__dict__
    if path not in held:
        held[path] = PreTokens(path)
    return held[path]


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.astype("<i4").tobytes())


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), "<i4").astype(np.int64)


class _Block:
    """Documents that share one list of distinct pre-tokens, gathered slice by slice."""

    def __init__(self):
        self.ids, self.sizes, self.held, self.lists, self.rows, self.bytes = [], [], [], [], 0, 0

    def add(self, ids: pa.Array, flat: np.ndarray, offsets: np.ndarray, cutter: PreTokens) -> None:
        words, row = cutter.split(flat, offsets)
        many = len(words.dictionary)
        pair, times = np.unique(row * max(many, 1) + words.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
        self.held.append((self.rows + pair // max(many, 1), pair % max(many, 1), times))
        self.lists.append(pa.DictionaryArray.from_arrays(pa.array(np.arange(many, dtype=np.int32)), words.dictionary))
        self.ids.append(ids), self.sizes.append(np.diff(offsets))
        self.rows, self.bytes = self.rows + len(ids), self.bytes + len(flat)

    def row(self, block: int) -> pa.RecordBatch:
        """block, the documents with their bytes, words and how often each of them stands in each document."""
        shared = pa.chunked_array(self.lists).unify_dictionaries()
        row = np.concatenate([x[0] for x in self.held])
        word = np.concatenate([c.indices.to_numpy(zero_copy_only=False)[x[1]] for c, x in zip(shared.chunks, self.held)]).astype(np.int64)
        times = np.concatenate([x[2] for x in self.held])
        order = np.lexsort((word, row))
        row, word, times = row[order], word[order], times[order]
        words = shared.chunk(0).dictionary.cast(pa.binary())
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), one(pa.concat_arrays(self.ids)), one(pa.array(np.concatenate(self.sizes), pa.int64())), one(words),
             pa.array([_packed(np.bincount(row, minlength=self.rows))], pa.binary()), pa.array([_packed(np.diff(word, prepend=0))], pa.binary()),
             pa.array([_packed(times)], pa.binary())], names=["block", "ids", "sizes", "words", "many", "steps", "times"])


def frequencies(docs: DataFrame, settings: CountSettings) -> DataFrame:
    """The pre-token frequencies of all documents, one row for each block of documents.

    block; ids and sizes (bytes) of its documents; words: its distinct pre-tokens; many: distinct pre-tokens of each
    document; steps: differences between their places in words, all documents one after the other; times: how often
    each of them stands in its document. The last three are packed 32-bit numbers.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cutter, number, block = pre_tokens(settings.vocabulary), TaskContext.get().partitionId() << 32, _Block()
        for batch, flat, offsets in pieces(batches):
            if block.rows and block.bytes + len(flat) > settings.block_bytes:
                yield block.row(number)
                number, block = number + 1, _Block()
            block.add(batch.column(0), flat, offsets, cutter)
        if block.rows:
            yield block.row(number)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"block long, ids array<{kind}>, sizes array<long>, words array<binary>, many binary, steps binary, times binary")


def piece_counts(words: DataFrame, settings: CountSettings) -> DataFrame:
    """The rows of words (column word first, then others) with n in the place of word: its number of pieces.

    Equal pre-tokens come together and are counted once, at the first of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, last = pre_tokens(settings.vocabulary), {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            fresh = [w for w in distinct if w not in last]
            known = last | dict(zip(fresh, cutter.count(fresh)))
            n = np.array([known[w] for w in distinct], np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
            last = {distinct[-1]: known[distinct[-1]]} if distinct else last
            yield pa.RecordBatch.from_arrays([pa.array(n), *batch.columns[1:]], names=["n", *batch.schema.names[1:]])

    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields if f.name != "word"]
    return words.repartition("word").sortWithinPartitions("word").mapInArrow(run, ", ".join(["n int", *others]))


def _totals(settings: CountSettings):
    """The documents of each block with the sum of their pre-tokens' pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, many, steps, times, places, counts = (batch.column(c)[i] for c in range(batch.num_columns))
                ids, many = ids.values, _unpacked(many.as_py())
                n = np.zeros(0 if counts.values is None else len(counts.values), np.int64)
                if len(n):
                    n[places.values.to_numpy()] = counts.values.to_numpy()
                total = np.concatenate([[0], np.cumsum(n[np.cumsum(_unpacked(steps.as_py()))] * _unpacked(times.as_py()))])
                ends = np.cumsum(many)
                tokens = (total[ends] - total[ends - many]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids, sizes.values, pa.array(tokens), pa.array(tokens > settings.limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, settings: CountSettings) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs (doc_id, text; other columns are left out).

    n_tokens is the length of what the library gives for the whole text, no special tokens added. Null and empty texts
    have 0 bytes and 0 tokens. Rows that repeat, or have no doc_id, each get their answer; no rows: no rows.

    1. Documents are cut into pre-tokens and give their frequencies, in blocks of documents that share one list of
    distinct pre-tokens; this is written once. 2. Equal pre-tokens of all blocks come together and are counted once. A
    pre-token stands once for a whole block, however frequent it is, so the most frequent one has a row for each
    block_bytes of text. 3. The counts are joined to the frequencies, block by block, and added up. Ids of tokens never leave
    the tokenizer.
    """
    spark = docs.sparkSession
    blocks = table(frequencies(docs, settings), "token-blocks")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    # rows are short from here on, or few and long
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    words = blocks.select(F.posexplode("words").alias("place", "word"), "block").select("word", "block", "place")
    found = piece_counts(words, settings).groupBy("block").agg(F.collect_list(F.struct("place", "n")).alias("found"))
    rows = blocks.drop("words").join(found, "block", "left")
    none = F.array().cast("array<int>")
    rows = rows.select("ids", "sizes", "many", "steps", "times", F.coalesce("found.place", none).alias("places"), F.coalesce("found.n", none).alias("counts"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_totals(settings), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
