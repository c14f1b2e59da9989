"""Not-modified revisits of web captures, resolved by an as-of join.

Each ``revisit`` record meets the latest strictly earlier ``response`` record of
the same canonical URL (of two at one time, the larger id).  The revisit's
validators are checked against that response: entity tags by weak comparison,
else Last-Modified.  When they agree the revisit stands for the response's
payload, and its headers are the stored ones, updated with those that a 304 may
change (``UPDATES``).

The join is a running maximum over (canonical URL, time).  URLs with more than a
thousandth of all records (at most a thousand of them) are cut at 63 quantiles of
their own times; each block runs alone and gets what the blocks before ended
with, so no URL's history has to be one task.

Defined results, in ``status``: ``no_response`` (no earlier full response, or
null URL or time), ``no_validator`` (nothing to compare), ``mismatch``, ``matched``.
Only matched revisits name a response and have headers.  Responses with null time
or URL are met by nothing.  Repeated records keep their rows.  Empty tables give
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored

# Response headers that a 304 response may update.
UPDATES = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
HOT_SHARE, CUTS = 1000, 63
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: str = "url") -> Column:
    """host[:port]/path[?query]: scheme, default port, fragment, tracking keys and
    letter case of the host don't count; query parts are sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(F.col(url)), "#[\\s\\S]*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    parts = F.filter(F.split(F.regexp_extract(rest, r"\?([\s\S]*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    query = F.array_join(F.array_sort(parts), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def header(headers: str, name: str) -> Column:
    """The last value of a header (names in lower case), else null."""
    return F.try_element_at(F.filter(F.col(headers), lambda h: h["name"] == name), F.lit(-1))["value"]


def _merged(stored_headers: Column, update: Column) -> Column:
    update = F.filter(update, lambda h: h["name"].isin(UPDATES))
    kept = F.filter(stored_headers, lambda h: ~F.coalesce(F.array_contains(F.transform(update, lambda u: u["name"]), h["name"]), F.lit(False)))
    return F.array_sort(F.concat(kept, update))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, status, response_id, payload_digest, headers.

    ``records``: record_id, url, ts (timestamp), kind (``response`` or
    ``revisit``), headers (array of name, value; names in lower case) and
    payload_digest."""
    h = F.expr(f"cast(headers as {HEADERS})")
    rows = records.select("record_id", canonical_url().alias("url_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "kind",
                          h.alias("headers"), "payload_digest").filter("kind in ('response', 'revisit')")
    rows = stored(rows, "captures")
    timed = rows.filter("url_key is not null and at is not null")

    per_url = timed.groupBy("url_key").agg(F.count("*").alias("n"))
    limit = timed.count() // HOT_SHARE
    hot = per_url.filter(F.col("n") > limit).select("url_key")
    cuts = timed.join(F.broadcast(hot), "url_key").groupBy("url_key").agg(
        F.percentile_approx("at", [i / (CUTS + 1) for i in range(1, CUTS + 1)], 1000).alias("cuts"))
    timed = timed.join(F.broadcast(cuts), "url_key", "left")  # a thousand rows at most
    timed = timed.withColumn("block", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("at"))), F.lit(0)))
    timed = timed.withColumn("block", F.greatest("block", F.lit(0))).drop("cuts")
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id", "headers", "payload_digest"))
    earlier = Window.partitionBy("url_key", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    met = timed.withColumn("own", F.max(full).over(earlier))
    ends = timed.join(F.broadcast(hot), "url_key", "left_semi").groupBy("url_key", "block").agg(F.max(full).alias("end"))
    blocks = Window.partitionBy("url_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("url_key", "block", F.max("end").over(blocks).alias("before"))
    met = met.filter("kind = 'revisit'").join(ends, ["url_key", "block"], "left")
    met = met.withColumn("r", F.coalesce("own", "before"))

    untimed = rows.filter("kind = 'revisit' and (url_key is null or at is null)").select(
        "record_id", "url_key", "headers", F.lit(None).cast(met.schema["r"].dataType).alias("r"))
    out = met.select("record_id", "url_key", "headers", "r").unionByName(untimed)
    out = out.withColumn("_rh", F.col("r.headers"))
    tag, old_tag = header("headers", "etag"), header("_rh", "etag")
    changed, old_changed = header("headers", "last-modified"), header("_rh", "last-modified")
    by_tag = F.when(tag.isNotNull() & old_tag.isNotNull(), _weak(tag) == _weak(old_tag))
    by_time = F.when(changed.isNotNull() & old_changed.isNotNull(), F.trim(changed) == F.trim(old_changed))
    agrees = F.coalesce(by_tag, by_time)
    status = (F.when(F.col("r").isNull(), "no_response").when(agrees.isNull(), "no_validator").when(agrees, "matched").otherwise("mismatch"))
    good = F.col("status") == "matched"
    return out.withColumn("status", status).select(
        "record_id", "url_key", "status", F.when(good, F.col("r.record_id")).alias("response_id"),
        F.when(good, F.col("r.payload_digest")).alias("payload_digest"), F.when(good, _merged(F.col("_rh"), F.col("headers"))).alias("headers"))


def fetch_history(pages: DataFrame, visits: int = 5) -> DataFrame:
    """Capture records of ``pages``, by arithmetic on ids and digests of the whole
    html: the first visit of a page (but of every 11th) and some later ones are
    full responses, the others answer 304 with the validators of the version they
    saw; every 7th sends a stale tag, every 13th no tag, every 17th no validator."""
    def is_full(v: Column | int) -> Column:
        v = F.lit(v) if isinstance(v, int) else v
        return ((v == 0) & (F.col("page_id") % 11 != 0)) | ((F.col("page_id") + v) % 4 == 3)

    rows = pages.select("page_id", "url", F.sha2(F.coalesce(F.col("html"), F.lit("")), 256).alias("sha"), F.length("html").alias("chars"))
    rows = rows.select("*", F.explode(F.array([F.lit(v) for v in range(visits)])).alias("v"))
    version = F.coalesce(*[F.when((F.col("v") >= v) & is_full(v), F.lit(v)) for v in reversed(range(visits))], F.lit(0))
    rows = rows.withColumns({"full": F.coalesce(is_full(F.col("v")), F.lit(True)), "version": version, "key": F.coalesce(F.col("page_id"), F.lit(0)) + F.col("v")})
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("v") * 7 + F.coalesce(F.col("page_id"), F.lit(0)) % 5).cast("int"))
    seen = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("version") * 3).cast("int")), "yyyy-MM-dd")
    tag = F.concat(F.lit('"'), F.substring("sha", 1, 16), F.lit("-"), F.col("version"), F.lit('"'))
    tag = F.when(F.col("full"), tag).when(F.col("key") % 7 == 0, F.lit('"stale"')).when(F.col("key") % 13 != 0, F.concat(F.lit("W/"), tag))
    tag = F.when(F.col("full") | (F.col("key") % 17 != 0), tag)
    changed = F.when(F.col("full") | (F.col("key") % 17 != 0), seen)
    pair = lambda k, v: F.struct(F.lit(k).alias("name"), v.alias("value"))
    both = [pair("date", F.date_format(day, "yyyy-MM-dd")), pair("cache-control", F.concat(F.lit("max-age="), F.col("v") * 60)),
            pair("etag", tag), pair("last-modified", changed)]
    response = [*both, pair("content-type", F.lit("text/html")), pair("content-length", F.coalesce(F.col("chars"), F.lit(0)).cast("string"))]
    revisit = [*both, pair("content-length", F.lit("0")), pair("connection", F.lit("close"))]
    headers = F.filter(F.when(F.col("full"), F.array(*response)).otherwise(F.array(*revisit)), lambda h: h["value"].isNotNull())
    url = (F.when(F.col("v") == 1, F.concat("url", F.lit("#seen"))).when(F.col("v") == 3, F.regexp_replace("url", "^http://", "https://")).otherwise(F.col("url")))
    return rows.select((F.col("page_id") * visits + F.col("v")).alias("record_id"), url.alias("url"), day.cast("timestamp").alias("ts"),
                       F.when(F.col("full"), "response").otherwise("revisit").alias("kind"), headers.alias("headers"),
                       F.when(F.col("full"), F.concat_ws("-", "sha", "version")).alias("payload_digest"))
