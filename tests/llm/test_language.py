"""Language by compression: held-out accuracy, rejections, and edges."""

from laneflow.llm import language as lang
from laneflow.llm import queries
from laneflow.llm.store import read

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    truth = {r.doc_id: r.lang for r in read(spark, SF, "documents").collect()}
    rows = queries.op9_language(spark, SF).collect()
    assert len(rows) == len(truth) and {r.doc_id for r in rows} == set(truth)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    told = [r for r in held if not r.rejected]
    assert len(told) >= 0.97 * len(held) and sum(r.lang_pred == truth[r.doc_id] for r in told) >= 0.985 * len(told)
    assert all(0 <= r.score <= 1 for r in rows)


def test_letters():
    assert lang.letters("Ça VA, 3 bien!") == "ça va bien".encode()
    assert lang.letters("123 !? \n") == lang.letters("") == b"" and lang.letters("«»—") == b"" and lang.letters("日本") == "日本".encode()


EDGES = [(1, None, "en"), (2, "", "en"), (3, "123 --", "de"), (7, "the and that with this from there " * 20000, "en"), (9, "the and that with this", "en"),
         (10, "der die das und nicht mit von zu den", "de"), (10, "der die das und nicht mit von zu den", "de"), (None, "the and that", "en"), (8, "und der die das nicht", None)]


def test_edges(spark):
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in EDGES], "doc_id long, text string, lang string, lang_pred string, score double")
    out = lang.language_id(docs).collect()
    assert len(out) == len(EDGES)
    by = {r.doc_id: r for r in out}
    assert {by[i].lang_pred for i in (1, 2, 3)} == {"und"} and {by[i].score for i in (1, 2, 3)} == {0.0} and by[3].rejected
    assert by[8].lang_pred in ("en", "de") and by[7].lang_pred == "en"
    kept = lang.keep_identified(docs)
    assert kept.columns == docs.columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang.language_id(docs).collect()] == [("und", 0.0)]
    assert lang.language_id(docs.limit(0)).count() == 0


def test_the_sample_is_bounded(spark):
    settings = lang.LanguageSettings(sample_rows=20, row_chars=50, dictionary_bytes=600)
    dictionaries = lang.fit(read(spark, SF, "documents"), settings)
    assert set(dictionaries) == {"en", "de", "fr", "es"} and all(0 < len(d) <= 600 for d in dictionaries.values())


def test_seventy_languages(spark):
    """Each is learned, in blocks of any size, with the same answer as in one."""
    words = {f"l{i:02d}": [f"{chr(97 + i % 26)}{chr(97 + i // 3 % 26)}{chr(97 + j)}o{i}x".translate({ord(d): chr(103 + int(d)) for d in "0123456789"}) for j in range(12)] for i in range(70)}
    rows = [(1000 * k + n, " ".join(own[(n + j) % 12] for j in range(30)), name) for k, (name, own) in enumerate(words.items()) for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {r[0]: r[2] for r in rows}
    answers = [sorted(map(tuple, lang.language_id(docs, lang.LanguageSettings(block=n)).collect())) for n in (7, 32, 100)]
    assert answers[0] == answers[1] == answers[2]
    assert sum(truth[r[0]] == r[2] for r in answers[0]) >= 0.99 * len(rows) and {r[2] for r in answers[0]} == set(words)


def test_the_sample_is_from_all_over_a_text(spark):
    """A shared header doesn't stand for a text: all parts of it come into the dictionary."""
    docs = spark.createDataFrame([(1, "header " * 2000 + "middle " * 2000 + "ending " * 2000, "en")], "doc_id long, text string, lang string")
    body, = lang.fit(docs, lang.LanguageSettings(row_chars=400)).values()
    assert 300 < len(body) <= 420 and all(w in body for w in (b"header", b"middle", b"ending"))


def plain(text, dictionaries, settings):
    import zstandard

    body = lang.letters(text or "")
    if not body or not dictionaries:
        return "und", 0.0, 0, True
    how = zstandard.ZstdCompressionParameters.from_level(settings.level, min_match=settings.min_match, write_checksum=False, write_content_size=False, write_dict_id=False)
    sizes = sorted((len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how).compress(body)), n)
                   for n, d in dictionaries.items())
    second = sizes[1][0] if len(sizes) > 1 else 2 * sizes[0][0]
    lead = second - sizes[0][0]
    return sizes[0][1], min(1.0, 4.0 * lead / second), lead, len(sizes) > 1 and lead < settings.min_margin


def test_against_one_text_at_a_time(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(EDGES, "doc_id long, text string, lang string"))
    settings = lang.LanguageSettings(block=3)
    dictionaries = lang.learn(docs, settings)
    found = lang.identify(docs, dictionaries, settings).collect()
    assert [(r.lang_pred, r.score, r.margin_bytes, r.rejected) for r in found] == [plain(r.text, dictionaries, settings) for r in found]
