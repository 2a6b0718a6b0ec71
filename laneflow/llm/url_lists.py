"""URL filters over time: dated list entries as validity intervals, joined to captures as of their fetch time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Days that one slice of time has: a key's captures and intervals meet slice by slice.
SLICE_DAYS = 64


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path of a URL without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def depths_of(entries: DataFrame) -> tuple[list[int], list[int]]:
    """The numbers of labels that domain entries have, and of path parts that prefix entries have: two small lists, no
    longer than the longest domain and path among the entries."""
    labels = F.size(F.split("key", r"\."))
    parts = F.size(F.split("key", "/")) - 1
    found = entries.where("kind in ('domain', 'prefix') and key is not null").select(
        "kind", F.when(F.col("kind") == "domain", labels).otherwise(parts).alias("depth")).distinct().collect()
    return tuple(sorted(r.depth for r in found if r.kind == kind) for kind in ("domain", "prefix"))


def keys_of(host: Column, path: Column, labels: list[int], parts: list[int]) -> Column:
    """Every (kind, key) that an entry about this URL can have: the host, its last labels and the host with the leading parts
    of the path, as many of them as entries have (`depths_of`)."""
    names, steps = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != "")

    def of(kind: str, depths: list[int], most: Column, key) -> Column:
        counts = F.array(*[F.lit(d) for d in depths]).cast("array<int>")
        return F.transform(F.filter(counts, lambda d: (d > 0) & (d <= most)), lambda d: F.struct(F.lit(kind).alias("kind"), key(d).alias("key")))

    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("key")))
    domains = of("domain", labels, F.size(names), lambda d: F.array_join(F.slice(names, F.size(names) - d + 1, d), "."))
    prefixes = of("prefix", parts, F.size(steps), lambda d: F.array_join(F.concat(F.array(host), F.slice(steps, 1, d)), "/"))
    return F.when(host.isNotNull(), F.concat(own, domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """list, kind, key, allows, valid_from, valid_to from dated entries (list, kind, key, allows, action, dated).

    action: add or remove. An entry holds from the day it is added to the day before it is removed or added anew; an open
    end is null. Of a day's entries for a key a removal wins; repeated additions are one. Entries with a null key or date
    are left out; a removal without an addition has no effect. Intervals of a list and key don't overlap.
    """
    per_day = entries.where("key is not null and dated is not null").groupBy("list", "kind", "key", "dated").agg(
        F.max(F.col("action") == "remove").alias("removed"), F.max("allows").alias("allows"))
    following = F.lead("dated").over(W.partitionBy("list", "kind", "key").orderBy("dated"))
    return per_day.withColumn("valid_to", following).where("not removed").select(
        "list", "kind", "key", "allows", F.col("dated").alias("valid_from"), "valid_to")


def _slice(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SLICE_DAYS).cast("int")


def judge(captures: DataFrame, valid: DataFrame) -> DataFrame:
    """captures (url, fetched_on, and others) with host, blocked, n_active and decided_by.

    Each capture meets the entries valid on its day: n_active of them; the one with the longest key decides, an allowing one
    before a blocking one of equal length; decided_by: its list. No active entry, a null day or no host: not
    blocked, 0, null. Domains of any number of labels and prefixes of any number of path parts are found. Captures and intervals are joined by key and slice of time, so that the captures of a hot host
    spread over the slices, and a sort-merge join can split them further. Rows of captures that repeat stay apart.
    """
    names = [c for c in captures.columns if c not in ("host", "blocked", "n_active", "decided_by")]
    rows = captures.select(*[F.col(f"`{c}`") for c in names]).withColumn("host", host_of(F.col("url")))
    wanted = rows.where("host is not null and fetched_on is not null").select("url", "host", "fetched_on").distinct()
    keyed = wanted.select("url", "fetched_on", F.explode(keys_of(F.col("host"), path_of(F.col("url")), *depths_of(valid))).alias("k")).select(
        "url", "fetched_on", "k.kind", "k.key", _slice(F.col("fetched_on")).alias("slice"))
    span = wanted.agg(F.min(_slice(F.col("fetched_on"))).alias("first"), F.max(_slice(F.col("fetched_on"))).alias("last"))
    low, high = span.first()
    first = F.greatest(_slice(F.col("valid_from")), F.lit(low))
    last = F.least(F.coalesce(_slice(F.date_sub("valid_to", 1)), F.lit(high)), F.lit(high))
    sliced = valid.where(first <= last).withColumn("slice", F.explode(F.sequence(first, last)))
    active = keyed.join(sliced, ["kind", "key", "slice"]).where(
        (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    rank = F.struct(F.length("key").alias("n"), F.col("allows").cast("int").alias("a"), F.col("list"))
    found = active.groupBy("url", "fetched_on").agg(F.count("*").alias("n_active"), F.max(rank).alias("top"))
    out = rows.join(found.withColumnRenamed("url", "_url").withColumnRenamed("fetched_on", "_on"), (F.col("url") == F.col("_url")) & (F.col("fetched_on") == F.col("_on")), "left")
    return out.select(*[F.col(f"`{c}`") for c in names], "host", F.coalesce(F.col("top.a") == 0, F.lit(False)).alias("blocked"),
                      F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("top.list").alias("decided_by"))


# The given tables have neither fetch days nor lists. Both are made from the pages, by digits of md5.

START = "2024-01-01"


def _digit(text: str, place: int) -> Column:
    return F.expr(f"instr('0123456789abcdef', substring(md5(`{text}`), {place}, 1)) - 1")


def captures_of(pages: DataFrame) -> DataFrame:
    """page_id, url, fetched_on: the day follows from page_id and spreads over 600 days."""
    return pages.select("page_id", "url", F.date_add(F.lit(START).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(600)).cast("int")).alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries about the hosts of the pages: block lists by host, domain and whole path, an allow list by path prefix."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host is not null")
    day = lambda n: F.date_add(F.lit(START).cast("date"), n.cast("int"))
    d = lambda place: _digit("key", place)

    def dated(keys: DataFrame, name: str, kind: str, most: int, allows: bool) -> DataFrame:
        added = 32 * d(2) + 2 * d(3)
        events = F.array(
            F.struct(F.lit("add").alias("action"), day(added).alias("dated")),
            F.when(d(5) < 12, F.struct(F.lit("remove").alias("action"), day(added + 30 + 4 * d(4)).alias("dated"))),
            F.when(d(7) < 8, F.struct(F.lit("add").alias("action"), day(added + 60 + 8 * d(6)).alias("dated"))))
        return keys.distinct().where(d(1) < most).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), "key", F.lit(allows).alias("allows"), F.explode(F.array_compact(events)).alias("e")).select(
            "list", "kind", "key", "allows", "e.action", "e.dated")

    labels, parts = F.split("host", r"\."), F.filter(F.split("path", "/"), lambda x: x != "")
    last = lambda n: hosts.where(F.size(labels) >= n).select(F.array_join(F.slice(labels, -n, n), ".").alias("key"))
    under = lambda least, steps: hosts.where(F.size(parts) >= least).select(F.concat_ws("/", "host", steps).alias("key"))
    lists = (dated(hosts.select(F.col("host").alias("key")), "spam", "host", 6, False), dated(last(3), "adult", "domain", 5, False),
             dated(last(2), "parked", "domain", 3, False), dated(under(1, F.slice(parts, 1, 1)), "trusted", "prefix", 6, True),
             dated(under(2, parts), "defaced", "prefix", 4, False))
    return reduce(DataFrame.unionByName, lists)


#: op7 as DuckDB SQL.
SQL = r"""
with parsed as (
  select page_id, url, date '2024-01-01' + ((page_id * 37) % 600)::int as fetched_on,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x != '') as parts
  from pages),
named as (select *, string_split(host, '.') as labels from parsed),
keys as (
  select distinct 'spam' as list, 'host' as kind, host as key, 6 as most, false as allows from named where host is not null
  union all
  select distinct 'adult', 'domain', array_to_string(labels[-3:], '.'), 5, false from named where host is not null and len(labels) >= 3
  union all
  select distinct 'parked', 'domain', array_to_string(labels[-2:], '.'), 3, false from named where host is not null and len(labels) >= 2
  union all
  select distinct 'trusted', 'prefix', host || '/' || parts[1], 6, true from named where host is not null and len(parts) > 0
  union all
  select distinct 'defaced', 'prefix', host || '/' || array_to_string(parts, '/'), 4, false from named where host is not null and len(parts) > 1),
digits as (
  select *, list_transform(range(1, 8), lambda i: instr('0123456789abcdef', substr(md5(key), i::int, 1)) - 1) as d from keys),
picked as (select *, 32 * d[2] + 2 * d[3] as added from digits where d[1] < most),
events as (
  select list, kind, key, allows, false as removed, added as n from picked
  union all select list, kind, key, allows, true, added + 30 + 4 * d[4] from picked where d[5] < 12
  union all select list, kind, key, allows, false, added + 60 + 8 * d[6] from picked where d[7] < 8),
days as (
  select list, kind, key, allows, bool_or(removed) as removed, date '2024-01-01' + n::int as dated from events group by list, kind, key, allows, n),
valid as (
  select *, lead(dated) over (partition by list, kind, key order by dated) as valid_to from days),
probes as (
  select page_id, fetched_on, 'domain' as kind, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) as key
  from named where host is not null
  union all
  select page_id, fetched_on, 'host', host from named where host is not null
  union all
  select page_id, fetched_on, 'prefix', unnest(list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/')))
  from named where host is not null),
active as (
  select p.page_id, v.list, length(v.key) as n, v.allows
  from probes p join valid v on p.kind = v.kind and p.key = v.key and not v.removed and p.fetched_on >= v.dated and (v.valid_to is null or p.fetched_on < v.valid_to)),
top as (
  select page_id, count(*) as n_active, arg_max(not allows, (n, allows::int, list)) as blocked, arg_max(list, (n, allows::int, list)) as decided_by
  from active group by page_id)
select p.page_id, p.url, p.fetched_on, p.host, coalesce(t.blocked, false) as blocked, coalesce(t.n_active, 0) as n_active, t.decided_by
from named p left join top t using (page_id)
"""
