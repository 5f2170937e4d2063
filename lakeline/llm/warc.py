"""Not-modified revisits resolved to the response they stand for.

Records of a crawl are full responses and not-modified revisits.  Each revisit
is joined, as of its time, to the latest strictly earlier full response of the
same canonical url.  Validators are then checked: an entity tag by weak
comparison; without one, the modification date; a revisit without either, or
with one that differs, is not resolved.  The stored headers are updated with
those of the revisit that a not-modified answer may change (connection-level
fields and those that describe the stored body stay).

Canonical url: no scheme, no fragment; host in lower case without ``www.`` and
default ports; no slash at the path's end; query parameters sorted, tracking
ones dropped.

Defined results: a null or empty url is a canonical url of its own (empty).
Records of the same time are no earlier ones; a response without a time is
earlier than nothing, and a revisit without one has no prior response.  Of responses of one url and
time the greater id counts as later, then the greater validators; of those
equal in all, the one with the greatest digest and headers gives them.  Null
headers are none.  Each revisit row gives one row, also with a null or repeated
id; empty tables give none.

Scale: (url, time, id, validators), with each revisit's headers, are
range-partitioned, so one url's records spread over many tasks; each slice is resolved by a window, and what a slice
cannot know - the last response before it - is carried over by one row for
each (url, slice).  Headers come by a join on the response's url, time, id and
validators, against written tables, so AQE can split a response that many
revisits share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.common import tasks, written

# Header fields that a not-modified answer doesn't change.
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
                "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
TRACKING = r"^(utm_[a-z]*|fbclid|gclid)(=|$)"
RECORD = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, digest string"


def canonical_url(url: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~F.rlike(p, F.lit(TRACKING)))), "&")
    return F.concat(host, path, F.when(F.length(kept) > 0, F.concat(F.lit("?"), kept)).otherwise(""))


def weak(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(tag, r"^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted ones of ``update`` (names in lower case)."""
    new = F.map_filter(_lower_names(update), lambda k, _: ~k.isin(*KEPT_HEADERS))
    old = F.map_filter(_lower_names(stored), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def _lower_names(headers: Column) -> Column:
    """Header map with lower-case names; of equal names the first stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.coalesce(F.map_from_entries(first), F.create_map().cast("map<string,string>"))


def header_lines(headers: Column) -> Column:
    """``name: value`` lines in order of name."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def as_of(rows: DataFrame) -> DataFrame:
    """The revisits of ``rows`` with a column found: struct of the latest
    earlier response, null if there is none.  ``rows``: (record_id, curl, ts,
    response boolean, etag, last_modified) and others, which go along."""
    # Revisits go before responses of the same time: those are not earlier.
    order = ["ts", "response", "record_id", "etag", "last_modified"]
    sliced = written(rows.repartitionByRange(tasks(rows.sparkSession), "curl", *order).withColumn("slice", F.spark_partition_id()), "slices")
    seen = F.when(F.col("response") & F.col("ts").isNotNull(), F.struct("ts", "record_id", "etag", "last_modified"))
    inside = Window.partitionBy("slice", "curl").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("found", F.last(seen, ignorenulls=True).over(inside)).where(~F.col("response"))
    across = Window.partitionBy("curl").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sliced.groupBy("curl", "slice").agg(F.max(seen).alias("most")) \
        .withColumn("carry", F.last("most", ignorenulls=True).over(across)).where("carry is not null").select("curl", "slice", "carry")
    return local.join(written(carried, "carried"), ["curl", "slice"], "left").withColumn("found", F.when(F.col("ts").isNotNull(), F.coalesce("found", "carry"))).drop("carry", "slice", "response")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, curl, ts, status, refers_to, digest, headers map) of each
    revisit.  status: resolved, no_prior, changed or no_validator."""
    response = F.coalesce(F.col("kind") == "response", F.lit(False))
    rows = records.select("record_id", canonical_url(F.col("url")).alias("curl"), "ts", response.alias("response"), "etag", "last_modified",
                          F.when(~response, F.col("headers")).alias("update"))
    f = F.col("found")
    status = F.when(f.isNull(), "no_prior") \
        .when(F.col("etag").isNotNull(), F.when(weak(F.col("etag")).eqNullSafe(weak(f["etag"])), "resolved").otherwise("changed")) \
        .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified").eqNullSafe(f["last_modified"]), "resolved").otherwise("changed")) \
        .otherwise("no_validator")
    judged = written(as_of(rows).withColumn("status", status).drop("etag", "last_modified"), "judged")
    # One row for each response as it is found, so no revisit meets two; ids may be null or repeat.
    key = ["ts", "record_id", "etag", "last_modified"]
    stored = records.where(response).select(canonical_url(F.col("url")).alias("_curl"), *(F.col(c).alias(f"_{c}") for c in key), F.col("headers").alias("stored"), "digest") \
        .groupBy("_curl", *(f"_{c}" for c in key)) \
        .agg(F.max_by(F.struct("stored", "digest"), F.struct("digest", header_lines(_lower_names(F.col("stored"))))).alias("one")) \
        .select("_curl", *(f"_{c}" for c in key), "one.*")
    same = F.col("curl") == F.col("_curl")
    for c in key:
        same = same & f[c].eqNullSafe(F.col(f"_{c}"))
    resolved = F.col("status") == "resolved"
    return judged.join(written(stored, "stored"), same, "left") \
        .select("record_id", "curl", "ts", "status", F.when(resolved, f["record_id"]).alias("refers_to"), F.when(resolved, F.col("digest")).alias("digest"),
                F.when(resolved, merged_headers(F.col("stored"), F.col("update"))).alias("headers"))


def crawl_of_pages(pages: DataFrame) -> DataFrame:
    """Records derived from the pages table: for each page a full response, and
    a revisit a day later (for some, before it) with a validator of some kind."""
    page = F.col("page_id")
    base = pages.select(page, "url", F.coalesce(F.col("html"), F.lit("")).alias("html")).withColumn("digest", F.md5(F.col("html").cast("binary"))) \
        .select("page_id", "url", F.length("html").alias("n"), "digest", (page * 60).alias("t"))
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    date = (F.col("t") - F.pmod("t", F.lit(3600))).cast("string")
    response = base.select(
        (page * 2).alias("record_id"), "url", F.col("t").alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"), date.alias("last_modified"),
        F.create_map(F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Length"), F.col("n").cast("string"), F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), F.col("t").cast("string"), F.lit("ETag"), tag).alias("headers"), "digest")
    k = F.pmod(page, F.lit(8))
    sent = F.when(k.isin(0, 4), tag).when(k.isin(1, 5), F.concat(F.lit("W/"), tag)).when(k == 3, F.lit('"changed"'))
    when = F.when(F.pmod(page, F.lit(13)) == 5, F.col("t") - 30).otherwise(F.col("t") + 86400)
    revisit = base.select(
        (page * 2 + 1).alias("record_id"), "url", when.alias("ts"), F.lit("revisit").alias("kind"), sent.alias("etag"), F.when(k.isin(2, 6), date).alias("last_modified"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"), F.lit("date"), when.cast("string"),
                     F.lit("x-cache"), F.lit("revalidated")).alias("headers"), F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)
