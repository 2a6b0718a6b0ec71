"""Token counts by distinct pre-tokens, against the library on whole texts."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as how
from hypothesis import strategies as st

from laneflow.llm import queries
from laneflow.llm import token_counts as t
from laneflow.llm.store import read

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WHOLE = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CUTTER = t.PreTokens(MODEL)


def expected(docs):
    out = []
    for i, text in docs:
        n = len(WHOLE.encode(text or ""))
        out.append((i, len((text or "").encode()), n, n > 4096))
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    assert rows(queries.op12_token_counts(spark, SF)) == expected([(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()])


def counted(texts):
    bodies = [x.encode() for x in texts]
    words, row = CUTTER.split(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)]))
    n = np.array(CUTTER.count(words.dictionary.to_pylist()), np.int64)
    return np.bincount(row, weights=n[words.indices.to_numpy()] if len(n) else None, minlength=len(texts)).astype(int).tolist()


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "  two   blanks  ", "\n", "a\nb", "\n\n a", "a\tb\r\n", "▁a", "a▁b ▁▁ c", "<s> </s> <unk> <0x0A>", "\0a", "don't ... e.g. www.x.com!?",
       "日本語テキスト", "éﬁＡ 　x", "🙂🙂‍🧑", "aaaaaaaaaaaaaaaaaaaaaaaa", "x" * 5000, "===== ##### 12345678901234567890", "ÿ\u0085 ﻿"]


def test_odd_texts():
    assert counted(ODD) == [len(WHOLE.encode(x)) for x in ODD]


@how(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="ab ▁\n.,thein", max_size=60)), max_size=6))
def test_any_texts(texts):
    assert counted(texts) == [len(WHOLE.encode(x)) for x in texts]


@pytest.mark.parametrize("size", [1, 200, 1 << 25])
def test_odd_rows_in_blocks_of_any_size(spark, size):
    docs = [*enumerate(ODD), (3, None), (3, "a"), (None, "no id"), (None, None), (99, "the long one " * 40000)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, words string, n_tokens int").repartition(3)
    settings = t.CountSettings(vocabulary=MODEL, block_bytes=size)
    assert rows(t.token_counts(df, settings)) == expected(docs)
    assert rows(t.token_counts(df.limit(0), settings)) == []
    assert rows(t.token_counts(df.where("text is null or text = ''"), settings)) == expected([d for d in docs if not d[1]])


def test_a_pre_token_has_one_row_per_block(spark):
    docs = spark.createDataFrame([(i, "the same few words again and again " * 50) for i in range(200)], "doc_id long, text string").repartition(8)
    settings = t.CountSettings(vocabulary=MODEL, block_bytes=1000)
    blocks = t.frequencies(docs, settings)
    words = blocks.selectExpr("explode(words) as word", "block").selectExpr("word", "block", "word as kept")
    found = t.piece_counts(words, settings).collect()
    assert len(found) == 7 * blocks.count() and {(bytes(r.kept).decode(), r.n) for r in found} == {
        (w, len(WHOLE.encode("\n" + w)) - 2) for w in (" the", " same", " few", " words", " again", " and", " ")}


def test_models_that_change_texts_are_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, x: x.lower())
    with pytest.raises(ValueError):
        t.PreTokens(MODEL)
