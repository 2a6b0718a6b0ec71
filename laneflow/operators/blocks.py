"""Ordered work on groups that may be too large for one task.

A window over a group puts the whole group into one task. Here every group is cut into blocks of its order column, and each
block gets what it needs from the blocks before it: the last few rows, a state, or a running sum. Results are the same as
over the whole group, whatever the block size, and all groups take the same path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneflow.config import BLOCK_FRAMES
from laneflow.session import stored

BLOCK, HALO = "_block", "_halo"

#: Blocks whose sums are added up together, before the sums of such spans are.
_SPAN = 4096


def block_of(order: str, block: int) -> Column:
    """Number of the block of `block` order values that a row lies in, rounded down."""
    return F.expr(f"(`{order}` - pmod(`{order}`, {block}L)) div {block}L")


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


@dataclass(frozen=True)
class Carried:
    """What blocks tell the later blocks of their group, besides their last rows.

    `rows`: columns added to the rows of a block, one dict after the other (windows by keys and `_block`); `summary`: aggregates
    over a block; `steps`: columns added to the summaries, one dict after the other (windows by keys, in block order);
    `names`: those that the copies of earlier rows carry; own rows have null there.
    """

    rows: Sequence[dict[str, Column]] = ()
    summary: dict[str, Column] = field(default_factory=dict)
    steps: Sequence[dict[str, Column]] = ()
    names: Sequence[str] = ()


def in_blocks(df: DataFrame, keys: Sequence[str], order: str, rows_before: int, block: int | None = None,
              history: Column | None = None, carried: Carried | None = None) -> DataFrame:
    """Rows with `_block` and `_halo`, ready for windows over `keys` and `_block`.

    `keys` are not null, `order` is a whole number, unique within `keys`. Every block also holds copies, marked `_halo`, of
    the last `rows_before` rows before it, or of the last row before it that meets `history`. The input is read twice:
    for the rows, and for one summary row per block, from which the copies are made.
    """
    if history is not None and rows_before != 1:
        raise ValueError("with history, one row is kept")
    block, carried = block or BLOCK_FRAMES, carried or Carried()
    columns = df.columns
    numbered = df.withColumn(BLOCK, block_of(order, block))
    own = numbered.withColumn(HALO, F.lit(False))
    if carried.names:
        for new in carried.rows:
            numbered = numbered.withColumns(new)
    usable = F.lit(True) if history is None else F.coalesce(history, F.lit(False))
    ranked = numbered.withColumn("_usable", usable)
    back = Window.partitionBy(*keys, BLOCK, "_usable").orderBy(F.desc(order))
    ranked = ranked.withColumn("_from_end", F.row_number().over(back))
    if not carried.names:
        ranked = ranked.filter(F.col("_from_end") <= rows_before)   # cut down before the rows are exchanged
    tail = F.when((F.col("_from_end") <= rows_before) & F.col("_usable"), F.struct(order, *[c for c in columns if c != order]))
    blocks = ranked.groupBy(*keys, BLOCK).agg(
        F.sort_array(F.collect_list(tail)).alias("_tail"), *[value.alias(name) for name, value in carried.summary.items()])
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    for new in carried.steps:
        blocks = blocks.withColumns(new)
    if history is None:
        # every block has a row, so the last rows lie in as many blocks at most
        before = F.flatten(F.collect_list("_tail").over(along.rowsBetween(-rows_before, -1)))
    else:
        filled = F.when(F.size("_tail") > 0, F.col("_tail"))
        before = F.last(filled, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_before", before)
    last = F.slice("_before", F.greatest(F.size("_before") - rows_before, F.lit(0)) + 1, rows_before)
    copies = blocks.select(BLOCK, *carried.names, F.explode(last).alias("_row")).select(
        *[F.col(f"_row.{c}").alias(c) for c in columns], BLOCK, F.lit(True).alias(HALO), *carried.names)
    return own.unionByName(copies, allowMissingColumns=bool(carried.names))


def running_total(df: DataFrame, value: Column, name: str, order: str, keys: Sequence[str] = (),
                  block: int = BLOCK_FRAMES, span: int = _SPAN) -> DataFrame:
    """Rows with the sum of `value` up to and including each row, by `order` within `keys`.

    `order` is a whole number, unique within `keys`. Blocks are summed first, then spans of blocks; only the sums of spans,
    one row for `span` blocks, are added up in one task per key. The input is read twice.
    """
    # as a struct, a null key is a value like any other, in the window and in the join
    whole = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    number = block_of(order, block)
    valued = df.withColumn("_value", value).withColumn("_group", F.struct(whole.alias("key"), number.alias(BLOCK)))
    sums = valued.groupBy("_group").agg(F.sum("_value").alias("_sum"))
    spanned = sums.withColumn("_span", F.struct(F.col("_group.key").alias("key"), block_of(f"_group`.`{BLOCK}", span).alias("n")))
    totals = spanned.groupBy("_span").agg(F.sum("_sum").alias("_of_span"))
    before_span = totals.select(F.col("_span").alias("_same_span"), F.coalesce(F.sum("_of_span").over(
        Window.partitionBy("_span.key").orderBy("_span.n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before_span"))
    inside_span = F.sum("_sum").over(Window.partitionBy("_span").orderBy(f"_group.{BLOCK}").rowsBetween(Window.unboundedPreceding, -1))
    before = spanned.withColumn("_inside_span", F.coalesce(inside_span, F.lit(0))).join(
        before_span, F.col("_span") == F.col("_same_span")).select(
        F.col("_group").alias("_same_group"), (F.col("_inside_span") + F.col("_before_span")).alias("_before"))
    inside = Window.partitionBy("_group").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        valued.withColumn("_inside", F.sum("_value").over(inside))
        .join(before, F.col("_group") == F.col("_same_group"))
        .select(*df.columns, (F.col("_before") + F.col("_inside")).cast("long").alias(name))
    )


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """Rows with their number by `order`, 1 for the first; rows with a null `order` come first. Stores the rows once.

    The rows are dealt in ranges of `order` with bounds from a sample of it, so the ranges hold about as many rows each however
    the values are spaced. Rows are numbered inside their range, after all rows of the ranges before; only the sizes of
    the ranges, one per partition, come to the driver.
    """
    ranged = stored(df.repartitionByRange(F.col(order).asc_nulls_first()).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    starts, upto = [], 0
    for number, count in sizes:
        starts.append((number, upto))
        upto += count
    starts = df.sparkSession.createDataFrame(starts, "_range int, _before long")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first()))
    return ranged.withColumn("_inside", inside).join(starts, "_range").select(
        *df.columns, (F.col("_before") + F.col("_inside")).alias(name))
