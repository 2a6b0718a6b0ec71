"""Tokens, packing and repacking: round trips, and exhaustive packing of small inputs."""

import dataclasses
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from laneflow.llm import queries
from laneflow.llm import sequences as s
from laneflow.llm.arrays import texts
from laneflow.llm.packing import best_fit, lower_bound
from laneflow.llm.store import read
from laneflow.llm.tokens import WordEncoder

SF = "/root/testdata/sf0.001"
VOCABULARY = path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(VOCABULARY)
TOKENIZER.encode_special_tokens = True


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


ALPHABET = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "1", "23", "!", "$$", "<|endoftext|>", " ", "　", "日本", "😀", "٣",
            "é", "\x00", "'t", " 've", "\r\n", "​", "\x85", "\x1c", "'l", "'d"]


def test_encoder_equals_tokenizer():
    own, t = WordEncoder(VOCABULARY), TOKENIZER
    rng = random.Random(5)
    for _ in range(400):
        rows = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(14))) for _ in range(5)]
        ids, at = own.encode(*texts(pa.array(rows)))
        assert [ids[at[i]:at[i + 1]].tolist() for i in range(5)] == [x.ids for x in t.encode_batch(rows, add_special_tokens=False)]


def fewest(lengths, size):
    """Bins of the best packing, by trying all."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_and_bound(seed):
    rng = np.random.default_rng(seed)
    size = 20
    lengths = rng.integers(1, size + 1, rng.integers(1, 9))
    bins, offsets = best_fit(lengths, size)
    for b in range(bins.max() + 1):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == [0, *itertools.accumulate(x for _, x in own)][:-1] and sum(x for _, x in own) <= size
    # best fit decreasing, step by step
    rooms, expected = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fit = [r for r in rooms if r >= lengths[i]]
        expected[i] = min(fit) if fit else size
        if fit:
            rooms.remove(min(fit))
        rooms.append(expected[i] - lengths[i])
    assert [size - offsets[i] for i in range(len(lengths))] == [expected[i] for i in range(len(lengths))]
    assert lower_bound(lengths, size) <= fewest(list(lengths), size) <= bins.max() + 1


def check_pieces(rows, docs, size):
    """All documents come back, piece by piece, and sequences are gapless and small enough."""
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == {d for d, _ in docs}
    for doc, text in docs:
        ids = [*plain(text), 0]
        own = sorted(by[doc], key=lambda r: r.start)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and 1 <= r.length <= size
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(own) == 1 or all(r.length == size for r in own[1:-1]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    rows = queries.op6_repacking(spark, SF).collect()
    bins = check_pieces(rows, docs, 2048)
    assert bins <= -(-sum(r.length for r in rows) // 2048) + 1


@pytest.mark.parametrize("group", [7, 40, 1000])
def test_repacking(spark, group):
    rng = random.Random(group)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(200)] + [(900, None), (901, ""), (902, "x y " * 400)]
    settings = s.PackSettings(VOCABULARY, size=64, group=group)
    rows = s.certified_packing(spark.createDataFrame([(*d, "m") for d in docs], "doc_id long, text string, piece string"), settings).collect()
    bins = check_pieces(rows, docs, 64)
    once = s.certified_packing(spark.createDataFrame(docs, "doc_id long, text string"), s.PackSettings(VOCABULARY, size=64, group=group, rounds=1)).select("sequence_id").distinct().count()
    assert lower_bound(np.array([r.length for r in rows]), 64) <= bins <= once


def test_matrices(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()] + [(9001, None), (9002, "")]
    settings = s.PackSettings(VOCABULARY, size=128, shard_tokens=5000)
    found = {}
    for r in s.packed_matrices(spark.createDataFrame(docs, "doc_id long, text string"), settings).collect():
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == 128 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= 128 and (ids[r.cu_seqlens[-1]:] == 0).all()
        assert r.resets[:len(r.doc_ids)] == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.pieces) == len(r.starts) == len(r.cu_seqlens) - 1
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found.setdefault(doc, []).append((start, ids[a:b].tolist()))
    assert {d: [i for _, x in sorted(own) for i in x] for d, own in found.items()} == {d: [*plain(t), 0] for d, t in docs}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    settings = s.PackSettings(VOCABULARY)
    assert s.certified_packing(docs, settings).count() == 0
    assert s.packed_matrices(docs, settings).count() == 0


def test_only_the_first_piece_is_shorter(spark):
    docs = [(1, "word " * 5000), (2, "x"), (3, None), (4, "word " * 2047), (5, "word " * 2048)]
    rows = s.certified_packing(spark.createDataFrame(docs, "doc_id long, text string"), queries.packing_settings()).collect()
    check_pieces(rows, docs, 2048)
    assert all(r.length == 2048 for r in rows if r.piece) and max(r.piece for r in rows) >= 2


def test_rows_without_id_or_with_one_id_are_dealt_over_groups(spark):
    """Many equal rows are no one group: the parts stay small, and the bins are as few as can be."""
    docs = spark.createDataFrame([(None, "a b c " * 220)] * 500 + [(7, "d e f " * 220)] * 500, "doc_id long, text string").repartition(4)
    settings = dataclasses.replace(queries.packing_settings(), group=100)
    rows = s.certified_packing(docs, settings).collect()
    assert len(rows) == 1000 and len({(r.sequence_id, r.offset) for r in rows}) == 1000
    assert {r.length for r in rows} <= set(range(600, 683))  # three to a sequence
    assert len({r.sequence_id for r in rows}) <= -(-1000 // 3) + 10


def test_matrices_query(spark):
    """The registered query at its own size, against the ids of whole texts."""
    own = TOKENIZER
    texts = {r.doc_id: r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()}
    found = {}
    for r in queries.op3_token_matrices(spark, "/root/testdata/sf0.001").collect():
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == 2048 and r.cu_seqlens[0] == 0
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found.setdefault(doc, []).append((start, ids[a:b].tolist()))
    assert {d: [i for _, x in sorted(p) for i in x] for d, p in found.items()} == {
        d: [*own.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
