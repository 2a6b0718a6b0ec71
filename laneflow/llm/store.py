"""Tables that a query reads and the ones that it writes between its steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laneflow.session import work_folder

#: Rows in an Arrow batch. Texts are long: the default of 10,000 could hold gigabytes.
ARROW_ROWS = "512"
#: Bytes in one, as Spark fills it; a longer row is a batch of its own.
ARROW_BYTES = str(4 << 20)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python tasks get from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows below the shared folder and reads them: the lineage ends here, and lost executors cost nothing."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


#: Bits of the map that `may_hold` sends along, a power of two: at most 2^18 words of 64 bits.
_BITS = 1 << 24


def may_hold(rows: DataFrame, key: str, ids: DataFrame, id_: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among the ids (all that are, and by chance some others), and those whose key surely isn't.

    A map of bits, of fixed size, is broadcast: long rows need no exchange to learn that they have no part in a join. Where ids
    are so many that the map is full, all rows may hold, and the join after it does all the work.
    """
    word, bits, place = (_free(rows, name) for name in ("_word", "_bits", "_place"))
    hashed = lambda c: F.xxhash64(c).bitwiseAND(_BITS - 1)
    known = ids.where(F.col(id_).isNotNull()).select(hashed(F.col(id_)).alias("h")).groupBy(F.shiftright("h", 6).alias(word)).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias(bits))
    asked = rows.withColumns({word: F.shiftright(hashed(F.col(f"`{key}`").cast(ids.schema[id_].dataType)), 6),
                              place: hashed(F.col(f"`{key}`").cast(ids.schema[id_].dataType)).bitwiseAND(63).cast("int")})
    asked = asked.join(F.broadcast(known), word, "left")
    found = F.getbit(bits, place) == 1
    plain = [F.col(f"`{c}`") for c in rows.columns]
    return asked.where(found).select(*plain), asked.where(~F.coalesce(found, F.lit(False))).select(*plain)


def _free(rows: DataFrame, name: str) -> str:
    """A column name like this one that the rows don't have."""
    while name in rows.columns:
        name += "_"
    return name
