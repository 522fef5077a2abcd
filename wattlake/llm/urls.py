"""URL filter by a temporal list join.

Dated list entries (a kind of key, a value, an action, a day) become validity
intervals: an entry holds from its day until the next entry of the same key.
Every capture is evaluated against the entries active on the day it was
fetched; the most specific one decides: the address, then the host, then its
parent domains from the longest.

Only DataFrame functions are used. Entries are first reduced to one per key and
day, so a key's history is bounded by days however often it is listed. Captures
are reduced to distinct (host, day) and (address, day) pairs before the list
join, which is salted, so a suffix of most hosts is spread over ``SALTS`` tasks;
decisions are joined back on salted keys, so a host that holds a third of all
captures is spread over as many a day.

Defined results: a null or malformed url has an empty host and no decision; a
null fetch day matches nothing; of several entries of one key on one day a
block wins; repeated captures each get a row; an empty table of captures gives no
rows and an empty list no decisions; only the columns named are read, so further
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def host_of(url: Column) -> Column:
    """Lower-case host of an address, without user and port; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(host, F.lit("."))


def address_of(url: Column) -> Column:
    """Host and path of an address, without query, fragment and a closing slash; empty without a host."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(host_of(url) == "", "").otherwise(F.concat(host_of(url), F.rtrim(path, F.lit("/"))))


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(kind, value, action, listed)`` as ``(kind, value, spells)``: ``spells`` are dated actions with their ends."""
    daily = (
        entries.where("kind is not null and value is not null and listed is not null")
        .groupBy("kind", "value", "listed").agg(F.max(F.col("action") == "block").alias("block"))
    )
    after = Window.partitionBy("kind", "value").orderBy("listed")
    spells = daily.withColumn("until", F.lead("listed").over(after))
    return spells.groupBy("kind", "value").agg(F.collect_list(F.struct("listed", "until", "block")).alias("spells"))


def _active(day: Column) -> Column:
    """The spell that holds on ``day``, or null."""
    holds = F.filter("spells", lambda s: (s["listed"] <= day) & (s["until"].isNull() | (day < s["until"])))
    return F.get(holds, F.lit(0))


def _decisions(captures: DataFrame, listed: DataFrame, salts: int) -> DataFrame:
    """The most specific active entry of each (host, day): domains of a host are its suffixes, the host included."""
    pairs = captures.where("host <> '' and fetched is not null").select("host", "fetched").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value"),
            F.when(i == 1, F.array(F.lit("host"), F.lit("domain"))).otherwise(F.array(F.lit("domain"))).alias("kinds"),
            i.alias("up"),
        ),
    )
    keys = pairs.select("host", "fetched", F.explode(suffixes).alias("s")).select(
        "host", "fetched", F.col("s.value").alias("value"), F.col("s.up").alias("up"), F.explode("s.kinds").alias("kind")
    )
    # a suffix such as "com" belongs to a large share of all hosts: keys are salted, and so is the list, one row a key
    salted = listed.where("kind <> 'address'").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = keys.withColumn("part", F.pmod(F.xxhash64("host", "fetched"), F.lit(salts)).cast("int"))
    found = keys.join(salted, ["kind", "value", "part"]).withColumn("spell", _active(F.col("fetched")))
    rank = F.struct((-F.col("up")).alias("up"), (F.col("kind") == "host").alias("own"))
    best = F.max_by(F.struct("kind", "value", "spell"), rank).alias("best")
    return found.where("spell is not null").groupBy("host", "fetched").agg(best).select("host", "fetched", "best.*")


def filter_urls(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """``captures(page_id, url, fetched)`` with ``host``, the deciding entry (``kind``, ``value``, ``listed``) and ``blocked``."""
    listed = intervals(entries)
    rows = captures.select(
        "page_id", "url", "fetched", host_of(F.col("url")).alias("host"), address_of(F.col("url")).alias("address"),
        F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    by_host = _decisions(rows, listed, salts).select(
        "host", "fetched", F.struct("kind", "value", "spell").alias("by_host"), salt
    )
    addresses = rows.where("address <> '' and fetched is not null").select("address", "fetched").distinct()
    by_address = (
        addresses.join(listed.where("kind = 'address'").withColumnRenamed("value", "address"), "address")
        .withColumn("spell", _active(F.col("fetched"))).where("spell is not null")
        .select("address", "fetched", F.struct("kind", F.col("address").alias("value"), "spell").alias("by_address"), salt)
    )
    decided = rows.join(by_host, ["host", "fetched", "salt"], "left").join(by_address, ["address", "fetched", "salt"], "left")
    entry = F.coalesce("by_address", "by_host")
    return decided.select(
        "page_id", "url", "host", "fetched", entry["kind"].alias("kind"), entry["value"].alias("value"),
        entry["spell"]["listed"].alias("listed"), F.coalesce(entry["spell"]["block"], F.lit(False)).alias("blocked"),
    )
