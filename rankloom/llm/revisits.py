"""Not-modified revisits of a web archive, resolved against the latest earlier full response.

Records are range-sorted by canonical URL and time, so the records of one URL may span partitions and a
URL with a third of all records is no hot key. Within a partition the latest response before a record is
a running window; a URL that starts in an earlier partition takes over that one's last response, of
which there is one small row per URL and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import canonical_url as web_form
from .common import Scratch

#: Headers that a not-modified answer may change in what is stored (fixed values).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def _unescaped(url: Column) -> Column:
    """Escapes of letters, digits and ``-._~`` as these characters, other escapes in upper case."""
    escapes = F.array_distinct(F.regexp_extract_all(url, F.lit("%[0-9A-Fa-f]{2}"), F.lit(0)))

    def form(escape: Column) -> Column:
        sign = F.char(F.conv(F.substring(escape, 2, 2), 16, 10).cast("bigint"))
        return F.when(sign.rlike(r"^[A-Za-z0-9._~-]$"), sign).otherwise(F.upper(escape))

    spelled = F.aggregate(escapes, url, lambda done, e: F.replace(done, e, form(e)))
    return F.when(url.contains("%"), spelled).otherwise(url)


def canonical_url(url: Column) -> Column:
    """One form of equal addresses, a path at least and no fragment; null without scheme and host.

    Of http and https the host is in lower case without a last dot, the user is as it was, an empty or
    default port and the segments ``.`` and ``..`` are gone, and escapes that need none are characters.
    Of other schemes only scheme and host change.
    """
    url = _unescaped(F.trim(url))
    part = lambda n: F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^#]*)", n)
    scheme, host, rest = F.lower(part(1)), part(2), part(3)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    user = F.regexp_extract(host, "^(.*@)?", 1)
    site = F.lower(F.regexp_replace(host, "^.*@", ""))
    other = F.concat(scheme, F.lit("://"), user, site, path)
    return F.when(host == "", None).when(scheme.isin("http", "https"), web_form(url)).otherwise(other)


def lower_names(headers: Column) -> Column:
    """Headers under lower-case names; of names equal but for case the first stays; null is empty."""
    entries = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    first = F.aggregate(
        entries,
        F.slice(entries, 1, 0),
        lambda done, e: F.when(F.exists(done, lambda d: d["key"] == e["key"]), done).otherwise(
            F.concat(done, F.array(e))
        ),
    )
    return F.map_from_entries(F.coalesce(first, F.array().cast("array<struct<key:string,value:string>>")))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def outcome(asked: Column, stored: Column) -> Column:
    """Whether the revisit's validators fit the response: etags if both have one, else modification dates."""
    etags = asked["etag"].isNotNull() & stored["etag"].isNotNull()
    dates = asked["last-modified"].isNotNull() & stored["last-modified"].isNotNull()
    fits = (
        F.when(etags, _weak(asked["etag"]) == _weak(stored["etag"]))
        .when(dates, asked["last-modified"] == stored["last-modified"])
        .otherwise(True)
    )
    return F.when(stored.isNull(), "no response").when(fits, "resolved").otherwise("mismatch")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``record_id, url, response_id, outcome, headers``, one row per revisit in ``records``.

    ``records(record_id bigint, kind string, url string, ts bigint, status int, headers map)``: kind is
    ``response`` or ``revisit``, other rows play no part. A full response has status 200; the latest one
    strictly before the revisit counts, of those at one time the one with the largest id, and validators
    are checked against it alone. ``outcome`` is ``resolved``, ``mismatch`` or ``no response``, the last
    also for a null or unusable url or time. Headers are the stored ones with the permitted ones of the
    revisit, for resolved revisits; null for the others. ``response_id`` is given also for a mismatch.
    Repeated revisits give repeated rows; null headers are none. An empty table gives an empty one.
    """
    scratch = Scratch(records.sparkSession)
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rows = records.filter((F.col("kind") == "revisit") | full).select(
        F.col("record_id").cast("bigint").alias("record_id"),
        canonical_url(F.col("url")).alias("url"),
        F.col("ts").cast("bigint").alias("ts"),
        (F.col("kind") == "response").alias("is_response"),
        lower_names(F.col("headers")).alias("headers"),
    )
    placed = F.col("url").isNotNull() & F.col("ts").isNotNull()
    response = F.when(F.col("is_response"), F.struct("ts", "record_id", "headers"))
    # false sorts first: at one time the revisit comes before the response
    sort = ["ts", "is_response", "record_id"]
    spread = scratch.keep(
        rows.filter(placed).repartitionByRange("url", *sort).withColumn("part", F.spark_partition_id())
    )
    running = Window.partitionBy("part", "url").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    near = spread.withColumn("found", F.last(response, ignorenulls=True).over(running))
    # the last response of a URL in each partition, handed on to its later partitions
    ends = spread.groupBy("url", "part").agg(
        F.max_by(response, F.struct(F.when(F.col("is_response"), F.col("ts")), "record_id")).alias("end")
    )
    several = F.count("*").over(Window.partitionBy("url"))
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = scratch.keep(
        ends.withColumn("several", several).filter("several > 1")
        .select("url", "part", F.last("end", ignorenulls=True).over(earlier).alias("handed"))
        .filter("handed is not null")
    )
    found = (
        near.filter(~F.col("is_response"))
        .join(handed, ["url", "part"], "left")
        .select("record_id", "url", "headers", F.coalesce("found", "handed").alias("found"))
    )
    lost = rows.filter(~F.col("is_response") & ~placed).select(
        "record_id", "url", "headers",
        F.lit(None).cast("struct<ts:bigint,record_id:bigint,headers:map<string,string>>").alias("found"),
    )
    stored, asked = F.col("found.headers"), F.col("headers")
    fresh = F.map_filter(asked, lambda name, _: name.isin(*PERMITTED))
    kept = F.map_filter(stored, lambda name, _: ~F.map_contains_key(fresh, name))
    state = outcome(asked, stored)
    return found.unionByName(lost).select(
        "record_id", "url",
        F.col("found.record_id").alias("response_id"),
        state.alias("outcome"),
        F.when(state == "resolved", F.map_concat(kept, fresh)).alias("headers"),
    )
