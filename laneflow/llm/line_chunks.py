"""Line dedup by content-defined chunks of lines, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.store import may_hold, table


@dataclass(frozen=True)
class ChunkSettings:
    """last_digit: a pair of lines may end a chunk if its rolling hash starts with a hex digit up to this one ('7': half
    of them); min_lines: lines with more than white space that a chunk needs to be removed."""

    last_digit: str = "7"
    min_lines: int = 2


def chunked(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """Adds `_chunks`: the lines of text in runs, as array<struct<text, lines, solid, at>>; at is the number of the first line.

    The rolling hash at a line is the hash of the hashes of this line and the one before. A chunk starts at a line whose
    rolling hash is small, unless that of the line before is small too. So a boundary depends on three lines alone:
    text put in or cut out elsewhere moves no boundary, and every chunk but the last has two lines or more. Null and empty
    text is one empty line.
    """
    out = docs.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    out = out.withColumn("_hashes", F.transform("_lines", lambda line: F.md5(line)))
    out = out.withColumn("_small", F.transform("_hashes", lambda h, i: F.when(
        i == 0, True).otherwise(F.substring(F.md5(F.concat(F.get("_hashes", i - 1), h)), 1, 1) <= settings.last_digit)))
    out = out.withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: (i == 0) | (
        F.get("_small", i) & ~F.get("_small", i - 1))))
    runs = F.transform("_starts", lambda at, i: F.slice("_lines", at + 1, F.coalesce(F.get("_starts", i + 1), F.size("_lines")) - at))
    out = out.withColumn("_runs", runs)
    return out.withColumn("_chunks", F.transform("_runs", lambda run, i: F.struct(
        F.array_join(run, "\n").alias("text"), F.size(run).alias("lines"),
        F.size(F.filter(run, lambda line: F.trim(line) != "")).alias("solid"), F.get("_starts", i).alias("at")))).drop("_lines", "_hashes", "_small", "_starts", "_runs")


def repeated_chunks(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """(doc_id, removed): the places of the chunks that repeat an earlier one, byte for byte.

    Earlier: smaller (doc_id, place); rows without doc_id take no part. Chunks meet by hash first, so that the bytes of a chunk travel only if its hash
    repeats; then equal bytes are counted as one group. A hot group is pre-aggregated, and the join back can be split.
    """
    rows = chunked(docs.select("doc_id", "text"), settings).select("doc_id", F.posexplode_outer("_chunks").alias("place", "chunk"))
    rows = rows.where((F.col("chunk.solid") >= settings.min_lines) & F.col("doc_id").isNotNull()).select(
        "doc_id", "place", F.col("chunk.text").alias("body"), F.xxhash64("chunk.text").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    again = table(rows.join(often, "key", "left_semi"), "repeated-chunks")
    first = again.groupBy("key", "body").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return again.join(first.select("key", "body", "first"), ["key", "body"]).where(
        "doc_id != first.doc_id or place != first.place").groupBy("doc_id").agg(F.collect_set("place").alias("removed"))


def line_dedup(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """docs with its text without repeated multi-line chunks, and n_lines, n_removed_lines, n_chunks, n_removed_chunks.

    The first of equal chunks stays. Rows with the same doc_id count as one document; a row without doc_id loses
    nothing. Null text stays null, and a text that loses nothing stays as it is, byte for byte.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines", "n_chunks", "n_removed_chunks")]
    removed = repeated_chunks(docs, settings).withColumnRenamed("doc_id", "_id")
    joined = docs.select(*[F.col(f"`{c}`") for c in names]).join(removed, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    out = chunked(joined, settings).withColumn("_gone", F.coalesce("removed", F.array().cast("array<int>")))
    kept = F.filter("_chunks", lambda chunk, i: ~F.array_contains("_gone", i))
    gone = F.filter("_chunks", lambda chunk, i: F.array_contains("_gone", i))
    lines = lambda chunks: F.aggregate(chunks, F.lit(0), lambda n, chunk: n + chunk["lines"])
    text = F.when(F.size("_gone") == 0, F.col("text")).otherwise(F.array_join(F.transform(kept, lambda chunk: chunk["text"]), "\n"))
    return out.select(
        *[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in names], lines(F.col("_chunks")).alias("n_lines"),
        lines(gone).alias("n_removed_lines"), F.size("_chunks").alias("n_chunks"), F.size("_gone").alias("n_removed_chunks"))


#: A run of lines as one number: its first line times this, and its last line.
_CODE = 1 << 31


def _runs(rows: DataFrame, text: str, settings: ChunkSettings) -> DataFrame:
    """Adds `_lines` of the text and `_runs`, its runs of `min_lines` solid lines with the blank ones between, in the form of _CODE."""
    rows = rows.withColumn("_lines", F.split(F.coalesce(text, F.lit("")), "\n", -1))
    rows = rows.withColumn("_solid", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.trim(F.get("_lines", i)) != ""))
    begins = F.slice("_solid", 1, F.greatest(F.size("_solid") - (settings.min_lines - 1), F.lit(0)))
    return rows.withColumn("_runs", F.transform(
        begins, lambda at, i: at.cast("long") * _CODE + F.get("_solid", i + settings.min_lines - 1))).drop("_solid")


def _later(rows: DataFrame, name: str, settled: DataFrame | None = None) -> DataFrame:
    """Of rows (doc_id, at, body, key, ...) those whose body stands at an earlier (doc_id, at) too, byte for byte.

    Bodies meet by hash (key) first: a map of the hashes that repeat is broadcast, so that other bodies never travel. Then equal
    bytes are counted as one group. A hot group is pre-aggregated, and the join back can be split. settled: keys of rows that are
    known to be later ones, each as often as it is known; where no two others have a key, its rows may be left out.
    """
    found = rows.select("key", F.lit(1).alias("n"))
    if settled is not None:
        found = found.unionByName(settled.select("key", F.lit(-1).alias("n")))
    often = found.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    again = table(may_hold(rows, "key", often, "key")[0], name)
    first = again.groupBy("key", "body").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return again.join(first.select("key", "body", "first"), ["key", "body"]).where(~F.struct("doc_id", "at").eqNullSafe(F.col("first")))


def _bodies(rows: DataFrame) -> DataFrame:
    """Rows with `_lines` and `_runs` to one row (doc_id, at, run, body, key) for each run; at: its first line in `_lines`."""
    body = lambda run: F.array_join(F.slice("_lines", F.shiftright(run, 31).cast("int") + 1, (
        run.bitwiseAND(_CODE - 1) - F.shiftright(run, 31)).cast("int") + 1), "\n")
    kept = [c for c in rows.columns if c not in ("_lines", "_runs")]
    out = rows.select(*kept, F.explode(F.transform("_runs", lambda run: F.struct(run.alias("run"), body(run).alias("body")))).alias("one"))
    return out.select(*kept, "one.*").select(
        *kept, F.shiftright("run", 31).cast("int").alias("at"), "run", "body", F.xxhash64("body").alias("key"))


def _seeds(docs: DataFrame, settings: ChunkSettings) -> DataFrame:
    """(doc_id, run, key): the runs of solid lines inside the chunks that an earlier place has too, and the hashes of their text."""
    chunks = chunked(docs.select("doc_id", "text"), settings).select(
        "doc_id", F.explode(F.filter("_chunks", lambda chunk: chunk["solid"] >= settings.min_lines)).alias("chunk"))
    chunks = chunks.select("doc_id", F.col("chunk.at").alias("at"), F.col("chunk.text").alias("body"), F.xxhash64("chunk.text").alias("key"))
    inside = _runs(_later(chunks, "repeated-chunks").select("doc_id", F.col("at").alias("chunk_at"), "body"), "body", settings)
    runs = _bodies(inside.select("doc_id", "chunk_at", "_lines", "_runs"))
    return runs.select("doc_id", (F.col("run") + F.col("chunk_at").cast("long") * (_CODE + 1)).alias("run"), "key")


def repeated_spans(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """(doc_id, gone): the numbers of the lines that stand in a run of `min_lines` solid lines which an earlier place has too.

    Earlier: smaller (doc_id, line); rows without doc_id take no part. Content-defined chunks that repeat are the seeds:
    all their runs are gone. A seed grows run by run over its edges, and a passage too short to hold a chunk is
    found, by the runs that lie in no seed: each solid line begins one, with its blank lines, so that a passage of any length
    and place is found whole. The first place of a run lies in no seed, so a run that has no other place outside of seeds is settled
    by them. Chunks and runs meet by hash, then by their bytes.
    """
    docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    seeds = table(_seeds(docs, settings), "seeds")
    runs = _bodies(_runs(docs, "text", settings).select("doc_id", "_lines", "_runs"))
    every = _later(runs, "repeated-runs", seeds).select("doc_id", "run").unionByName(seeds.select("doc_id", "run"))
    gone = every.groupBy("doc_id").agg(F.collect_set("run").alias("runs"))
    lines = F.transform("runs", lambda run: F.sequence(F.shiftright(run, 31).cast("int"), run.bitwiseAND(_CODE - 1).cast("int")))
    return gone.select("doc_id", F.array_distinct(F.flatten(lines)).alias("gone"))


def drop_repeats(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """docs with its text without repeated passages of `min_lines` or more solid lines, and n_chars (if there) to match.

    The first place of every line stays, so no line goes from all documents. Other columns stay, and so does, byte for byte,
    a text that loses nothing. A document that loses everything but white space goes; one without text to begin with stays.
    Rows with the same doc_id count as one document; a row without doc_id loses nothing.
    """
    spans = table(repeated_spans(docs, settings), "repeated-lines").withColumnRenamed("doc_id", "_id")
    out = docs.join(spans, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    out = out.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone"), lambda i: F.get("_lines", i)), "\n")
    changed = F.col("gone").isNotNull() & F.col("text").isNotNull()
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.explode_outer(
        F.array(F.struct(F.when(changed, kept).otherwise(F.col("text")).alias("text"), changed.alias("changed")))).alias("_kept"))
    # a filter on what a generator gives stays above it: pushed further down, it would compute the lines again for each use
    text, changed = F.col("_kept.text"), F.col("_kept.changed")
    out = out.where(~changed | text.isNull() | (F.trim(F.translate(text, "\n\t\r", "")) != ""))
    fresh = {"text": text}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[fresh.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


#: op10: `line_dedup` over documents, as DuckDB SQL.
SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as i
  from documents),
small as (
  select *, i = 0 or substr(md5(lag(md5(line)) over d || md5(line)), 1, 1) <= '7' as s from lines window d as (partition by doc_id order by i)),
starts as (select *, i = 0 or (s and not lag(s) over d) as start from small window d as (partition by doc_id order by i)),
placed as (select *, (sum(start::int) over (partition by doc_id order by i))::int - 1 as place from starts),
chunks as (
  select doc_id, place, string_agg(line, chr(10) order by i) as body, count(*) as n,
         count(*) filter (trim(line, ' ') != '') as solid
  from placed group by doc_id, place),
marked as (
  select *, solid >= 2 and row_number() over (partition by body order by doc_id, place) > 1 as gone from chunks)
select doc_id, sum(n)::int as n_lines, coalesce(sum(n) filter (gone), 0)::int as n_removed_lines, count(*)::int as n_chunks,
       count(*) filter (gone)::int as n_removed_chunks,
       sha256(coalesce(string_agg(body, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
