"""What a chain of document filters does in every order: contractions of one table of counts per part."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"

# Along an axis of the table of counts: documents that pass the filter, that fail it, or all.
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)
_MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> dict[str, Column]:
    """Conditions under which a text (not null) fails filters A to D.

    A: under 200 words; B: fewer than half of the words are distinct; C: over 3 % of its code points are capitals A-Z; D: it
    has one of `#$%&*|`. Words are maximal runs of `[^\\x20\\x09-\\x0D]`.
    """
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, mask (bits of the failed filters A to D), good and toxic of every document."""
    failed = failures(F.col("_text"))
    bits = sum((F.when(failed[f], 1 << i).otherwise(0) for i, f in enumerate("ABCD")), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("_text")).select(
        "doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"), bits.alias("mask"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    known = known.where("good or toxic").withColumnRenamed("doc_id", "_id")
    joined = rows.join(known, F.col("doc_id") == F.col("_id"), "left")
    return joined.select("doc_id", "part", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: fails filter i of ABCDE), n, good, toxic: documents of each part by the filters that they fail.

    E fails if a smaller doc_id has the same text (told by its SHA-256) in the whole table. Documents of one text are first
    counted per part and label, with the count at the smallest id: however often a text stands there, few rows of
    it meet. Nobody's id is smaller than a null one, and a null one is smaller than none.
    """
    kinds = ["digest", "part", "mask", "good", "toxic"]
    ids = _marked(docs, labels).groupBy("doc_id", *kinds).agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    groups = ids.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("loose"))
    least = groups.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    own = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0) + F.col("loose")
    split = groups.join(least, "digest").select("part", "mask", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("bit"), own.alias("n")), F.struct(F.lit(1 << 4).alias("bit"), (F.col("n") - own).alias("n")))).alias("cell"))
    count = lambda flag: F.sum(F.when(flag, F.col("cell.n")).otherwise(0))
    return split.groupBy("part", (F.col("mask") + F.col("cell.bit")).alias("mask")).agg(
        F.sum("cell.n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def contractions(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of every order and step, from counts [n, good, toxic][a, b, c, d, e] (index 1: fails): arrays orders x steps.

    A step sees what passes the filters before it: `pass` along their axes, `fail` along its own, `all` along those to come.
    """
    orders = list(permutations(range(5)))
    before = np.array([[[_PASS if f in order[:s] else _ALL for f in range(5)] for s in range(5)] for order in orders])
    own = np.array(orders)
    rows, steps = np.indices(own.shape)
    fails, passes = before.copy(), before.copy()
    fails[rows, steps, own], passes[rows, steps, own] = _FAIL, _PASS
    only = np.array([[_FAIL if f == g else _PASS for g in range(5)] for f in range(5)])
    total = np.array([[_FAIL if f == g else _ALL for g in range(5)] for f in range(5)])
    sums = lambda choice: np.einsum("mabcde,na,nb,nc,nd,ne->mn", counts, *np.moveaxis(choice.reshape(-1, 5, 2), 1, 0), optimize=True)
    removed = sums(fails).reshape(3, *own.shape)
    shapley = np.zeros(5, np.int64)
    np.add.at(shapley, own, removed[0])
    return {"kept": sums(passes)[0].reshape(own.shape), "removed": removed[0], "redundant": sums(total)[0][own] - removed[0],
            "unique_fails": sums(only)[0][own], "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[own]}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, with kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    docs: doc_id, text, lang; labels: doc_id, quality, toxic; other columns are left out. part is lang, and the empty string
    if it is null. Null text is empty. Rows that repeat count as often as they stand there; a document is good or toxic if any
    label row of its doc_id says so. No documents: no rows. The counts of a part are 32 cells: one row, contracted in
    a task of its own; parts stay apart.
    """
    found = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = ["".join(FILTERS[i] for i in order) for order in permutations(range(5))]
        names = pa.array(np.repeat(orders, 5).tolist(), pa.string())
        steps = pa.array(np.tile(np.arange(1, 6), len(orders)), pa.int32())
        for batch in batches:
            for part, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.zeros((3, 32), np.int64)
                for cell in own:
                    counts[:, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                # bit 0 of a mask is the last axis of the reshaped counts
                table = contractions(counts.reshape(3, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1))
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(names), pa.string()), names, steps, *[pa.array(table[m].ravel(), pa.int64()) for m in _MEASURES]],
                                                 names=["part", "filter_order", "step", *_MEASURES])

    return found.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in _MEASURES))


#: `audit` over documents and labels, as DuckDB SQL.
SQL = r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
words as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts),
flags as (
  select doc_id, part,
         (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::int + 8 * regexp_matches(text, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > min(doc_id) over (partition by text), false)::int as mask,
         coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false) as good,
         coalesce(doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null), false) as toxic
  from words),
cells as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from flags group by part, mask),
filters as (select unnest([1, 2, 4, 8, 16]) as bit, unnest(['A', 'B', 'C', 'D', 'E']) as letter),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from filters a, filters b, filters c, filters d, filters e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
    and list_unique([a.bit, b.bit, c.bit, d.bit, e.bit]) = 5),
steps as (
  select filter_order, i::int as step, bits[i] as own, coalesce(list_sum(bits[:i - 1]), 0)::int as earlier
  from orders, range(1, 6) t(i)),
measured as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (mask & (earlier | own) = 0), 0)::bigint as kept,
         coalesce(sum(n) filter (mask & earlier = 0 and mask & own > 0), 0)::bigint as removed,
         coalesce(sum(n) filter (mask & earlier > 0 and mask & own > 0), 0)::bigint as redundant,
         coalesce(sum(n) filter (mask = own), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (mask & earlier = 0 and mask & own > 0), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (mask & earlier = 0 and mask & own > 0), 0)::bigint as toxic_lost
  from cells, steps group by part, filter_order, step, own)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from measured
"""
