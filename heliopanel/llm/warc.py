"""WARC captures: canonical URLs, header blocks, and resolution of not-modified revisits.

A revisit record (an answer 304, or an identical payload) has no body of its own.  It is
resolved against the latest earlier full response of the same canonical URL: an as-of join.
Validators then decide whether that response is the one the server confirmed, and the header
fields that a 304 may update are merged into the stored ones.

The as-of join sorts all records by ranges of (URL, time, id), so a URL with any share of
the records is spread over as many tasks.  Within a range a window looks back; the last full
response of a URL that goes on in the next range is carried over by a table of at most two
rows per range.  The sorted records are written once, with their range number, so both sides
see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

# Query parameters that name a visit, not a page.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|msclkid|jsessionid|phpsessid|sid)(=|$)"
# Fields that a 304 answer may replace in the stored response (HTTP caching).
UPDATABLE = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "vary", "via")
_AUTHORITY = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def canonical_url(url: F.Column) -> F.Column:
    """Host in lower case without user, ``www.`` and default port, path, sorted parameters; no scheme,
    fragment, closing slash or tracking parameter.  Null stays null; a text without ``://`` is kept, trimmed."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(plain, _AUTHORITY, 1), "^[^@]*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)?$", ""), "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(plain, _AUTHORITY + "([^?]*)", 2), "/+$", "")
    given = F.split(F.regexp_extract(plain, "[?](.*)$", 1), "&")
    params = F.array_sort(F.filter(given, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    whole = F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))
    return F.when(plain.rlike(_AUTHORITY), whole).otherwise(plain)


def header_map(block: F.Column) -> F.Column:
    """Fields of an HTTP header block, names in lower case; repeated fields are joined by commas.  Null: no fields."""
    lines = F.split(F.coalesce(block, F.lit("")), "\r?\n")
    pairs = F.transform(F.filter(lines, lambda x: x.rlike("^[^ :][^:]*:")), lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
        F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", ")))


def http_status(block: F.Column) -> F.Column:
    """Three-digit status of a header block's first line, or null."""
    return F.nullif(F.regexp_extract(block, "^HTTP/[0-9.]+ ([0-9]{3})", 1), F.lit("")).cast("int")


def prior_response(records: DataFrame) -> DataFrame:
    """The revisits, each with ``prior``: the latest earlier full response of its key (or null).

    ``records``: key, time, record_id, is_full, is_revisit, body (a struct kept for both sides).
    Earlier means smaller in (time, record_id).
    """
    ranged = records.repartitionByRange("key", "time", "record_id").withColumn("part", F.spark_partition_id())
    ranged = write_table(ranged, "warc-ranged")
    full = F.when(F.col("is_full"), F.struct("time", "record_id", "body"))
    back = Window.partitionBy("part", "key").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = ranged.withColumn("here", F.last(full, ignorenulls=True).over(back)).where("is_revisit")

    ends = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    edge = ranged.join(F.broadcast(ends), "part").where("key = low or key = high") \
        .groupBy("part", "key").agg(F.max(full.getField("time")).alias("t"),
                                    F.max_by(F.struct("time", "record_id", "body"), F.when(F.col("is_full"), F.struct("time", "record_id"))).alias("last"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = edge.withColumn("carried", F.last(F.when(F.col("t").isNotNull(), F.col("last")), ignorenulls=True).over(before)) \
        .select("part", "key", "carried").where("carried is not null")     # at most two rows per range
    return seen.join(F.broadcast(carried), ["part", "key"], "left") \
        .withColumn("prior", F.coalesce("here", "carried")).drop("here", "carried", "part")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: outcome, the response it stands for, and the merged header fields.

    ``records``: record_id long, type ('response' or 'revisit'), url, time (orderable), http
    (header block text), digest (of the payload).  A full response is a 'response' of status
    200 with a digest.  Outcomes: ``resolved``; ``mismatch`` (a validator differs);
    ``unverified`` (none to compare: taken as not resolved); ``no_response``.  Entity tags are
    compared weakly; without tags on both sides Last-Modified is compared, and without that
    the payload digest.

    Null url, time or id: such a record takes no part as a response, and a revisit gets
    ``no_response``.  Null header blocks have no fields.  Repeated records are resolved each;
    an empty table gives an empty result; further columns are ignored.
    """
    rows = records.select("record_id", "type", "url", "time", "digest", header_map(F.col("http")).alias("fields"),
                          http_status(F.col("http")).alias("status"), canonical_url(F.col("url")).alias("key"))
    body = F.struct("url", "digest", "fields")
    known = F.col("key").isNotNull() & F.col("time").isNotNull() & F.col("record_id").isNotNull()
    rows = rows.select("record_id", "time", "key", body.alias("body"), (F.col("type") == "revisit").alias("is_revisit"),
                       (known & (F.col("type") == "response") & (F.col("status") == 200)
                        & F.col("digest").isNotNull()).alias("is_full"),
                       known.alias("known"))
    rows = rows.withColumn("is_full", F.coalesce("is_full", F.lit(False))) \
        .withColumn("is_revisit", F.coalesce("is_revisit", F.lit(False))).where("is_full or is_revisit")
    rows = write_table(rows, "warc-parsed")         # the sort's sampling pass then reads its keys alone
    # unknown keys, times and ids cannot be ordered; spread them, as they may be many
    placed = prior_response(rows.where("known").drop("known"))
    lost = rows.where("not known").drop("known").withColumn("prior", F.lit(None).cast(placed.schema["prior"].dataType))
    both = placed.unionByName(lost)

    mine, theirs = F.col("body.fields"), F.col("prior.body.fields")
    tag = lambda m: F.regexp_replace(m["etag"], "^W/", "")
    same = F.coalesce(tag(mine) == tag(theirs), mine["last-modified"] == theirs["last-modified"],
                      F.col("body.digest") == F.col("prior.body.digest"))
    outcome = F.when(F.col("prior").isNull(), "no_response").when(same.isNull(), "unverified") \
        .when(same, "resolved").otherwise("mismatch")
    new = F.map_filter(mine, lambda k, _: k.isin(*UPDATABLE))
    merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
    ok = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id", F.col("body.url").alias("url"), F.col("key").alias("canonical_url"), "time", "outcome",
        F.when(ok, F.col("prior.record_id")).alias("response_id"),
        F.when(ok, F.col("prior.body.digest")).alias("digest"),
        F.when(ok, merged).alias("fields"))


def field_text(fields: F.Column) -> F.Column:
    """``name: value`` lines in the order of the names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")


# a crawl derived from pages ----------------------------------------------------------------------------
DAY = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def crawl_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records of the pages: each one's response, and one to three later revisits of it.

    Revisits ask by another spelling of the URL; one in seven pages has changed by then (its
    tag differs), and one in eleven servers sends no tag.
    """
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    p = pages.where("page_id is not null and url is not null and html is not null").select(
        F.col("page_id").alias("id"), "url", F.md5(F.col("html").cast("binary")).alias("digest"), F.length("html").alias("size"),
        F.pmod(F.col("page_id") * 7919, F.lit(2592000)).alias("second"))

    def at(seconds):
        return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))

    tag = F.when(F.col("id") % 11 == 5, F.lit(None)).otherwise(F.concat(F.lit('ETag: "'), F.substring("digest", 1, 16), F.lit('"')))
    response = p.select(
        (F.col("id") * 4).alias("record_id"), F.lit("response").alias("type"), "url", at(F.col("second")).alias("time"),
        F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                    F.concat(F.lit("Content-Length: "), F.col("size")), tag,
                    F.concat(F.lit("Last-Modified: "), F.date_format(at(F.col("second") - F.lit(86400)), DAY)),
                    F.lit("Cache-Control: max-age=60"), F.concat(F.lit("Date: "), F.date_format(at(F.col("second")), DAY)),
                    F.lit("")).alias("http"), "digest")
    n = F.explode(F.sequence(F.lit(1), (F.col("id") % 3 + 1).cast("int")))
    again = p.withColumn("n", n).withColumn("second", F.col("second") + F.col("n") * 3600)
    changed = F.col("id") % 7 == 3
    tag = F.when(F.col("id") % 11 == 5, F.lit(None)).otherwise(F.concat(
        F.when(F.col("n") == 2, F.lit('ETag: W/"')).otherwise(F.lit('ETag: "')),
        F.when(changed, F.lit("changed")).otherwise(F.substring("digest", 1, 16)), F.lit('"')))
    url = F.when(F.col("n") == 1, F.concat("url", F.lit("#part"))).when(
        F.col("n") == 2, F.regexp_replace("url", "^https?://", "HTTPS://www.")).otherwise(F.col("url"))
    revisit = again.select(
        (F.col("id") * 4 + F.col("n")).alias("record_id"), F.lit("revisit").alias("type"), url.alias("url"),
        at(F.col("second")).alias("time"),
        F.concat_ws("\r\n", F.lit("HTTP/1.1 304 Not Modified"), tag, F.lit("Content-Length: 0"),
                    F.concat(F.lit("Cache-Control: max-age="), F.col("n") * 100),
                    F.concat(F.lit("Date: "), F.date_format(at(F.col("second")), DAY)), F.lit("")).alias("http"),
        F.when(changed, F.lit(None)).otherwise(F.col("digest")).alias("digest"))
    return response.unionByName(revisit)
