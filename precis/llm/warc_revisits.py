"""Resolve not-modified captures to the full response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.common import pick, stored

#: Query parameters that only track where a visitor came from. Fixed values.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
#: Fields that a not-modified response never changes in the stored one (RFC 9110 and 9111). Fixed values.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
RECORD = ("record_id", "url", "ts", "kind", "etag", "last_modified", "headers", "payload")


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without last slash, sorted query without trackers.

    Scheme and fragment do not count. A null stays null.
    """
    plain = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, scheme + "([^/?]*)", 1)), "^www\\.|:(80|443)$", "")
    rest = F.regexp_replace(plain, scheme + "[^/?]*", "")
    path = F.rtrim(F.regexp_extract(rest, "(?s)^([^?]*)", 1), F.lit("/"))
    query = F.filter(
        F.split(F.regexp_extract(rest, "(?s)\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(""))


def field_map(headers: Column) -> Column:
    """Names in lower case, values of repeated names joined by a comma; null as no field."""
    entries = F.filter(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
                       lambda e: e["value"].isNotNull())
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
        F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == n), lambda e: e["value"]), ", ")))


def merged_headers(old: Column, new: Column) -> Column:
    """The stored response's fields, replaced by those that the not-modified one may change."""
    allowed = F.map_filter(field_map(new), lambda k, _: ~k.isin(*KEPT_FIELDS))
    return F.map_concat(F.map_filter(field_map(old), lambda k, _: ~F.array_contains(F.map_keys(allowed), k)), allowed)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def latest_response(records: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """Revisits with prior, the latest response of the same canonical URL with an earlier ts.

    All captures of a URL at one ts become one row, in the tasks before the shuffle, so a URL
    has at most ``bucket_seconds`` rows in a bucket of time, however often it was captured. A
    window looks back inside a bucket, and one row for each URL and bucket carries the last
    response of earlier buckets over. Revisits then look up their URL and ts; those tables are
    stored, so Spark can split a URL that has very many of them at one ts.
    """
    light = records.withColumn("site", canonical_url("url")).where("site is not null and ts is not null")
    response = F.when(F.col("kind") == "response", F.struct("record_id", "etag", "last_modified"))
    times = stored(light.groupBy("site", "ts").agg(
        F.max(response).alias("response"), F.max((F.col("kind") == "revisit").cast("int")).alias("asked")))
    times = times.select(
        "site", "ts", "asked", F.floor(F.col("ts") / bucket_seconds).alias("bucket"),
        F.when(F.col("response").isNotNull(), F.struct("ts", "response.*")).alias("response"))
    inside = Window.partitionBy("site", "bucket").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    near = times.withColumn("near", F.last("response", ignorenulls=True).over(inside)).where("asked = 1")
    earlier = Window.partitionBy("site").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = times.groupBy("site", "bucket").agg(F.max("response").alias("last")).select(
        "site", "bucket", F.last("last", ignorenulls=True).over(earlier).alias("far"))
    prior = stored(near.join(carried, ["site", "bucket"]).select("site", "ts", F.coalesce("near", "far").alias("prior")))
    seen = light.where("kind = 'revisit'").select("record_id", "site", "ts", "etag", "last_modified")
    return seen.join(prior, ["site", "ts"])


def resolve_revisits(records: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """Every revisit with the payload and headers it stands for.

    ``records`` has record_id (unique), url, ts (long, seconds), kind ("response" or
    "revisit"; others are left aside), etag, last_modified, headers (map), payload.
    A revisit is tied to the latest response of its canonical URL with an earlier
    ts; of several at one ts the largest record_id counts. Then its validators are
    checked: the entity tags by weak comparison if the revisit has one, else the
    last-modified dates. ``state`` is resolved, mismatch (a validator differs or the
    response lacks it), unchecked (the revisit has no validator) or orphan (no
    earlier response, null url or null ts). Only resolved rows have headers and
    payload (which may be null or empty, as the response's). An empty table gives none.

    Returns record_id, site, state, response_id, headers (map), payload.
    """
    rows = pick(records, *RECORD)
    tied = latest_response(rows, bucket_seconds)
    same = F.when(F.col("etag").isNotNull(), F.coalesce(_weak(F.col("etag")) == _weak(F.col("prior.etag")), F.lit(False)))
    same = same.when(F.col("last_modified").isNotNull(), F.coalesce(F.col("last_modified") == F.col("prior.last_modified"), F.lit(False)))
    state = F.when(F.col("prior").isNull(), "orphan").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch")
    tied = tied.select("record_id", state.alias("state"), F.col("prior.record_id").alias("response_id"))
    revisits = rows.where("kind = 'revisit'").select("record_id", "url", F.col("headers").alias("new"))
    checked = revisits.join(tied, "record_id", "left").select(
        "record_id", canonical_url("url").alias("site"), F.coalesce("state", F.lit("orphan")).alias("state"), "response_id", "new")
    full = rows.where("kind = 'response'").select(
        F.col("record_id").alias("stored_id"), F.col("headers").alias("old"), "payload")
    resolved = F.col("state") == "resolved"
    # Unresolved rows go by their own id, so that they are no hot key.
    checked = checked.withColumn("tied", resolved).withColumn("to", F.when(resolved, F.col("response_id")).otherwise(F.col("record_id")))
    full = full.withColumn("tied", F.lit(True)).withColumnRenamed("stored_id", "to")
    return checked.join(full, ["tied", "to"], "left").select(
        "record_id", "site", "state", "response_id", F.when(resolved, merged_headers(F.col("old"), F.col("new"))).alias("headers"), "payload")


def captures(pages: DataFrame, visits: int = 3) -> DataFrame:
    """Records as a crawl makes them, from pages: a full response of each, then ``visits`` not-modified ones.

    Later captures come by other spellings of the URL; by a digest of page and visit
    some lack validators, have another one, or were taken before the response.
    """
    page = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        (F.lit(1_700_000_000) + F.col("page_id") * 7).cast("long").alias("base"),
        F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"')).alias("tag"))
    date = F.concat(F.lit("day "), F.floor(F.col("base") / 86_400).cast("string"))
    full = page.select(
        (F.col("page_id") * (visits + 1)).alias("record_id"), "url", F.col("base").alias("ts"), F.lit("response").alias("kind"),
        F.col("tag").alias("etag"), date.alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length("html").cast("string"),
                     F.lit("ETag"), F.col("tag"), F.lit("Last-Modified"), date, F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        F.col("html").alias("payload"))
    digest = F.md5(F.concat_ws(":", F.col("page_id").cast("string"), F.col("visit").cast("string")))
    case = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int") % 8
    again = page.drop("html").withColumn("visit", F.explode(F.sequence(F.lit(1), F.lit(visits)))).withColumn("case", case)
    ts = F.col("base") + F.when(F.col("case") == 4, -1000).otherwise(F.col("visit") * 50_000)
    tag = F.when(F.col("case") == 0, F.lit('"other"')).when(F.col("case") >= 4, F.concat(F.lit("W/"), F.col("tag")))
    modified = F.when(F.col("case") == 1, date).when(F.col("case") == 2, F.lit("day 0"))
    later = again.select(
        (F.col("page_id") * (visits + 1) + F.col("visit")).alias("record_id"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"),
        ts.cast("long").alias("ts"), F.lit("revisit").alias("kind"), tag.alias("etag"), modified.alias("last_modified"),
        F.create_map(F.lit("Date"), ts.cast("string"), F.lit("cache-control"), F.concat(F.lit("max-age="), F.col("visit").cast("string")),
                     F.lit("Connection"), F.lit("close"), F.lit("Content-Length"), F.lit("0")).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return full.unionAll(later)
