"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.store import table


def _ends(links: DataFrame) -> DataFrame:
    """id, low, forked, deep of every id: its lowest lower neighbour (null: none), whether it has others too, whether higher ones too."""
    kind = links.schema["node"].dataType
    ends = links.select(F.inline(F.array(
        F.struct(F.col("node").alias("id"), F.col("low").alias("low")), F.struct(F.col("low").alias("id"), F.lit(None).cast(kind).alias("low")))))
    return ends.groupBy("id").agg(
        F.min("low").alias("low"), F.coalesce(F.min("low") != F.max("low"), F.lit(False)).alias("forked"),
        (F.count("low").between(1, F.count("*") - 1)).alias("deep"))


def _large_star(links: DataFrame, ends: DataFrame) -> DataFrame:
    """Each node hands its lowest neighbour to those above it: the lower end of a link is replaced by its own lowest."""
    lower = ends.where("low is not null").select(F.col("id").alias("low"), F.col("low").alias("lowest"))
    return links.join(lower, "low", "left").select("node", F.coalesce("lowest", "low").alias("low"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its lowest neighbour to its other lower ones. Aggregates before it joins: a hub's rows meet in no single task."""
    lowest = links.groupBy("node").agg(F.min("low").alias("lowest"))
    handed = links.join(lowest, "node").select(F.inline(F.array(
        F.struct(F.col("low").alias("node"), F.col("lowest").alias("low")), F.struct(F.col("node").alias("node"), F.col("lowest").alias("low")))))
    return handed.where("node != low").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id in a link; component_id is the smallest id it reaches. The rows are stored.

    Links may point either way, repeat, or join an id to itself (no effect). Ends as soon as every id has one lower neighbour at
    most and none has both lower and higher ones; the number of rounds grows with the logarithm of the number of nodes.
    Where no id has two lower neighbours, the small-star step would change nothing and is left out.
    """
    links = table(links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("low")).where("node != low"), "links")
    while True:
        ends = table(_ends(links), "components")
        forked, deep = ends.agg(F.bool_or("forked"), F.bool_or("deep")).first()
        if not forked and not deep:
            return ends.select("id", F.coalesce("low", "id").alias("component_id"))
        raised = _large_star(links, ends)
        links = table(_small_star(raised) if forked else raised, "links")
