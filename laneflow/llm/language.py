"""Language by compression: the language whose raw-content dictionary shortens a text most."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.store import remainder, small_batches

UNKNOWN = "und"

#: ASCII bytes that are no letters become blanks; bytes of longer UTF-8 characters stay.
_BLANKED = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class LanguageSettings:
    """Bounds of the fit and the rule of rejection.

    sample_rows: labelled rows a language's dictionary is cut from, at most about twice so many; row_chars: characters taken of
    each of them, in `windows` pieces spread over the whole text; dictionary_bytes: size of a dictionary; block: languages
    whose dictionaries a task holds at once; level: of zstandard; min_match: shortest repeat that it codes; min_margin:
    bytes by which the second language must be worse than the first, or the text is rejected.
    """

    sample_rows: int = 300
    row_chars: int = 1000
    windows: int = 4
    dictionary_bytes: int = 128 << 10
    block: int = 32
    level: int = 6
    min_match: int = 3
    min_margin: int = 2


def letters(text: str) -> bytes:
    """The words of a text in lower case, one blank between them; empty if it has no letter."""
    body = b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKED).split())
    if body and not body.isascii() and not any(97 <= c <= 122 for c in body):
        return body if any(c.isalpha() for c in text) else b""
    return body


def fit(labelled: DataFrame, settings: LanguageSettings = LanguageSettings()) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded sample of rows with text and lang.

    Every value of lang is learned. The sample of a language: the rows whose hash of id and text lies under a share of the hash
    range, a share that gives sample_rows on average; so it is spread over the whole table, and its size doesn't grow with
    it. A longer text gives pieces from all of its parts, at places that the hash shifts. Rows with null or letterless
    text are not used. No rows: no languages.
    """
    rows = labelled.where("text is not null and lang is not null")
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return {}
    share = F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(settings.sample_rows / r["count"]))])
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "text"), 11) / float(1 << 53)
    shift = F.shiftrightunsigned(F.xxhash64(F.lit(13), "doc_id", "text"), 11) / float(1 << 53)
    width, room = settings.row_chars // settings.windows, F.length("text") - settings.row_chars
    # between the pieces lie equal parts of what is left out, the first of them shifted
    pieces = F.transform(F.sequence(F.lit(0), F.lit(settings.windows - 1)), lambda i: F.substring(
        F.col("text"), (i * width + F.floor((i + shift) * room / settings.windows)).cast("int") + 1, F.lit(width)))
    text = F.when(room <= 0, F.col("text")).otherwise(F.array_join(pieces, " "))
    sample = rows.withColumn("place", place).where(F.col("place") < F.element_at(share, F.col("lang"))).select(
        "lang", "place", text.alias("text")).limit(2 * settings.sample_rows * len(counts)).collect()
    found: dict[str, list[tuple[float, bytes]]] = {}
    for r in sample:
        if body := letters(r.text):
            found.setdefault(r.lang, []).append((r.place, body))
    return {lang: b" ".join(x for _, x in sorted(own))[: settings.dictionary_bytes] for lang, own in sorted(found.items())}


def _sizes(dictionaries: list[bytes], settings: LanguageSettings):
    """A function from a text to its compressed size with each dictionary."""
    how = zstandard.ZstdCompressionParameters.from_level(
        settings.level, min_match=settings.min_match, write_checksum=False, write_content_size=False, write_dict_id=False)
    coders = []
    for body in dictionaries:
        own = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(compression_params=how)
        coders.append(zstandard.ZstdCompressor(dict_data=own, compression_params=how))
    return lambda body: [len(c.compress(body)) for c in coders]


def _two_least(names: list[str], dictionaries: list[bytes], settings: LanguageSettings):
    """Carries on the best language of each text, and the two least sizes, over one block of languages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _sizes(dictionaries, settings)
        for batch in batches:
            row, name, least, second = batch.columns
            out = []
            for t, n, a, b in zip(row.field("text"), name.to_pylist(), least.to_pylist(), second.to_pylist()):
                body = letters(t.as_py() or "")
                if body:
                    own = sizes(body)
                    best = int(np.argmin(own))
                    others = [x for i, x in enumerate(own) if i != best] + [x for x in (a, b) if x is not None]
                    # names come in order, so a tie stays with the earlier block
                    if a is None or own[best] < a:
                        n, a, b = names[best], own[best], min(others, default=None)
                    else:
                        b = min(x for x in (b, own[best]) if x is not None)
                out.append((n, a, b))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([row, *[pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))]], names=batch.schema.names)

    return run


def _judged(docs: DataFrame, dictionaries: dict[str, bytes], settings: LanguageSettings) -> DataFrame:
    """row (the row of docs), lang_pred, score, margin_bytes, rejected. Languages come block by block, and each block carries the best
    so far on."""
    small_batches(docs.sparkSession)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(None).cast("string").alias("name"),
                        F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("second"))
    names, schema = list(dictionaries), found.schema
    for at in range(0, len(names), settings.block):
        some = names[at : at + settings.block]
        found = found.mapInArrow(_two_least(some, [dictionaries[n] for n in some], settings), schema)
    second = F.coalesce("second", 2 * F.col("least"))
    lead, told = second - F.col("least"), F.col("name").isNotNull()
    return found.select(
        "row", F.coalesce("name", F.lit(UNKNOWN)).alias("lang_pred"), F.when(told, F.least(F.lit(1.0), 4.0 * lead / second)).otherwise(0.0).alias("score"),
        F.coalesce(lead, F.lit(0)).cast("long").alias("margin_bytes"), F.when(told & F.lit(len(names) > 1), lead < settings.min_margin).otherwise(~told).alias("rejected"))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """Adds lang_pred, score, margin_bytes and rejected to the rows of docs (its column `text`).

    The whole text is compressed once per language; the smallest wins, ties go to the first name. score:
    1 - best / second, stretched to 0..1. rejected: no letter or null text (`und`, 0), or a narrow margin.
    Columns of docs with the new names are replaced; all others pass through. With no language learned all is `und`; with one,
    twice its size stands for the second.
    """
    kept = docs.drop("lang_pred", "score", "margin_bytes", "rejected")
    return _judged(kept, dictionaries, settings).select("row.*", "lang_pred", "score", "margin_bytes", "rejected")


def learn(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> dict[str, bytes]:
    """Dictionaries from the documents that aren't held out: crc32 of the id modulo 3 is not 1."""
    return fit(docs.where(remainder("doc_id", 3) != 1), settings)


def language_id(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin_bytes, rejected of every document."""
    found = identify(docs.select("doc_id", "text"), learn(docs, settings), settings)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "margin_bytes", "rejected")


def keep_identified(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """The documents whose language is told, with their own columns."""
    return _judged(docs, learn(docs, settings), settings).where(~F.col("rejected")).select("row.*")
