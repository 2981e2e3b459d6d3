"""WARC: revisits that say "not modified" get the content of the response they refer to.

Records are rows ``(record_id, url, at, kind, status, etag, modified, headers, body)``; ``kind`` is ``response``
or ``revisit``, ``headers`` a map. A revisit is joined, as of its time, to the latest earlier
full response (status 200) of the same canonical url. It is resolved if the validators agree: its ETag, where both
have one, compared weakly; else its Last-Modified, where both have one; with no common validator it is not.
The resolved record has the response's body and headers, with those headers of the revisit that a 304 may
carry merged over them.

The as-of join is two window passes without any group in one task: per (url, bucket of time) the last
response, carried over the buckets; then per (url, bucket) the last response within. A url with a third of
all records is spread over its buckets, whose number grows with the records. Bodies of responses stay out of the
windows: a response is carried by its id and validators, its body is joined at the end. Revisits go through
the windows as they are, so nothing has to be joined back to them. Those of one much visited response
are dealt over several copies of its body; unresolved ones take no part in that join.

Null urls are left unresolved. At equal times a response stands before a revisit, smaller ids first.
Null times cannot be placed: such revisits stay unresolved and such responses are not found, nor are responses without an id.
Each revisit row gives one row, also where ids or whole rows repeat. Responses alike in id, url, time and
validators count as one, with the smallest body. Header names that differ in case only are one, the last
entry's value stands. Extra columns of the records stay on their rows; the result's own columns replace columns of
the same name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mnemospark.llm.staging import stage

#: Headers that a "not modified" answer may carry and a cache takes over; and the ports of the schemes.
MERGED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary", "warning")
PORTS = {"http": "80", "https": "443"}
FANOUT = 64  # buckets of time, of about equal numbers of records: this many, or its square
BUCKET_ROWS = 100_000  # records of a bucket beyond which there are more buckets
SHARED_BY = 256  # revisits of one response, at least, that share one copy of its body
HOT_BOUND = 100_000  # most responses whose revisits are dealt over copies; they are broadcast


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, ``/`` for an empty path; null stays null."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    for name, port in PORTS.items():
        host = F.when(scheme == name, F.regexp_replace(host, f":{port}$", "")).otherwise(host)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(url.isNull() | (scheme == ""), url).otherwise(F.concat(scheme, F.lit("://"), host, rest))


def weak(etag: Column) -> Column:
    """An ETag without its weakness mark."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def agree(left: str, right: str) -> Column:
    """Whether the validators of two structs agree."""
    tag = F.col(f"{left}.etag").isNotNull() & F.col(f"{right}.etag").isNotNull()
    date = F.col(f"{left}.modified").isNotNull() & F.col(f"{right}.modified").isNotNull()
    return F.when(tag, weak(F.col(f"{left}.etag")) == weak(F.col(f"{right}.etag"))).when(date, F.col(f"{left}.modified") == F.col(f"{right}.modified")).otherwise(False)


def bounds(records: DataFrame) -> list[list]:
    """Times that cut the records into buckets of about equal size, in one list, or in lists between every ``FANOUT``-th of them."""
    n = records.count()
    buckets = FANOUT if n <= FANOUT * BUCKET_ROWS else FANOUT * FANOUT
    found = records.agg(F.percentile_approx("at", [i / buckets for i in range(1, buckets)], 16 * buckets)).first()[0]
    cuts = sorted(set(found or []))
    return [cuts[i:i + FANOUT] for i in range(0, len(cuts), FANOUT)]


def bucket_of(at: Column, cuts: list[list]) -> Column:
    """Number of the bucket of a time: the list is found by the first cuts, the place by the list's own."""
    if not cuts:
        return F.lit(0)
    passed = lambda some: F.size(F.filter(some, lambda c: c <= at))
    numbers = lambda some: F.array(*map(F.lit, some)).cast("array<long>")
    row = passed(numbers([some[0] for some in cuts]))
    within = passed(F.element_at(F.array(*map(numbers, cuts)), F.greatest(row, F.lit(1))))
    return F.greatest(row - 1, F.lit(0)) * FANOUT + within


def key_of(url_key: Column) -> Column:
    """What tells responses of one id apart."""
    parts = [c for name in ("at", "etag", "modified") for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(url_key, *parts)


def latest_response(records: DataFrame) -> DataFrame:
    """``(record, url_key, mine, found)`` for each revisit that can be placed: the whole row, its validators, the latest earlier response."""
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull(), F.lit(False))
    url_key = canonical(F.col("url"))
    placed = records.where("url is not null and at is not null").where(full | (F.col("kind") == "revisit"))
    record = F.when(~full, F.struct(*map(quoted, records.columns)))
    v = F.struct("record_id", "etag", "modified", key_of(url_key).alias("key"))
    rows = placed.select(url_key.alias("url_key"), bucket_of(F.col("at"), bounds(placed)).alias("bucket"), "at", full.alias("full"), "record_id", v.alias("v"), record.alias("record"))
    last = Window.unboundedPreceding
    # The last response of each bucket, and from there the last before each bucket.
    ends = rows.groupBy("url_key", "bucket").agg(F.max(F.when(F.col("full"), F.struct("at", F.struct("record_id", "v").alias("r")))).alias("last"))
    over = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(last, -1)
    carried = ends.withColumn("before", F.last("last", ignorenulls=True).over(over)).select("url_key", "bucket", F.col("before.r.v").alias("before"))
    order = [F.col("at"), F.col("full").desc(), F.col("record_id"), F.col("v")]
    within = Window.partitionBy("url_key", "bucket").orderBy(*order).rowsBetween(last, Window.currentRow)
    seen = rows.withColumn("inside", F.last(F.when(F.col("full"), F.col("v")), ignorenulls=True).over(within)).where(~F.col("full"))
    return seen.join(carried, ["url_key", "bucket"], "left").select("record", "url_key", F.col("v").alias("mine"), F.coalesce("inside", "before").alias("found"))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`").alias(name)


def lowered(headers: Column) -> Column:
    """Headers by lower-case name; of equal names the last stands."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"])))


def with_bodies(found: DataFrame, responses: DataFrame) -> DataFrame:
    """``found`` rows ``(id, key, ...)`` with ``response``, the body and headers of the response of that id and key."""
    keys = ["id", "key"]
    share = max(SHARED_BY, found.count() // HOT_BOUND)  # so at most HOT_BOUND responses have more revisits than that
    hot = F.broadcast(found.groupBy(*keys).agg(F.ceil(F.count("*") / share).cast("int").alias("parts")).where("parts > 1"))
    marked = found.join(hot, keys, "left")
    cold = marked.where("parts is null").join(responses, keys, "left").drop("parts")
    spread = marked.where("parts is not null").withColumn("part", F.pmod(F.monotonically_increasing_id(), F.col("parts")).cast("int")).drop("parts")
    copies = responses.join(hot, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return cold.unionByName(spread.join(copies, [*keys, "part"], "left").drop("part"))


def resolve(records: DataFrame) -> DataFrame:
    """Each revisit with ``url_key``, ``refers_to``, ``resolved``, and the response's body with merged headers if resolved."""
    judged = latest_response(records).withColumn("resolved", F.col("found").isNotNull() & F.coalesce(agree("mine", "found"), F.lit(False)))
    judged = stage(judged.select("record", "url_key", F.col("found.record_id").alias("id"), F.col("found.key").alias("key"), "resolved"), "warc-found")
    content = F.struct(F.col("body"), F.array_sort(F.map_entries("headers")).alias("headers"))
    responses = records.where((F.col("kind") == "response") & (F.col("status") == 200)).where("url is not null and at is not null and record_id is not null") \
        .select(F.col("record_id").alias("id"), key_of(canonical(F.col("url"))).alias("key"), content.alias("response")).groupBy("id", "key").agg(F.min("response").alias("response"))
    done = with_bodies(judged.where("resolved"), responses)
    apart = records.where(F.col("kind") == "revisit").where("url is null or at is null").select(F.struct(*map(quoted, records.columns)).alias("record"))
    rest = judged.where("not resolved").unionByName(apart, allowMissingColumns=True).withColumn("resolved", F.lit(False))
    rows = done.unionByName(rest, allowMissingColumns=True)
    new = F.map_filter(lowered(F.col("record.headers")), lambda k, _: k.isin(*MERGED))
    old = F.map_filter(lowered(F.map_from_entries("response.headers")), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    ok = F.col("resolved")
    made = {"url_key": F.col("url_key"), "refers_to": F.col("id"), "resolved": ok}
    changed = {"headers": F.when(ok, F.map_concat(old, new)).otherwise(F.col("record.headers")), "body": F.when(ok, F.col("response.body")).otherwise(F.col("record.body"))}
    kept = [changed.get(c, F.col("record").getField(c)).alias(c) for c in records.columns if c.lower() not in made]
    return rows.select(*kept, *(c.alias(name) for name, c in made.items()))


def crawl_of(pages: DataFrame) -> DataFrame:
    """Records of a crawl made from pages: each page once as a response, once more as a revisit.

    The page's number is the time of the response. Its revisit comes 7 pages later by another spelling of the url, with
    the page's own ETag, with a changed one for every fifth page, and with none but a date for every third.
    """
    n, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    headers = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k.replace("_", "-")), v)])
    date = F.concat(F.lit("day "), F.floor(n / 100).cast("string"))
    response = pages.select((n * 2).alias("record_id"), "url", (n * 10).alias("at"), F.lit("response").alias("kind"), F.when(n % 11 == 0, 301).otherwise(200).alias("status"),
                            F.when(n % 3 != 0, tag).alias("etag"), date.alias("modified"),
                            headers(Content_Type=F.lit("text/html"), Date=date, Server=F.lit("a")).alias("headers"), F.col("html").alias("body"))
    url = F.concat(F.regexp_replace(F.col("url"), "^http://([^/?#]*)", "HTTP://$1:80"), F.lit("#again"))
    revisit = pages.select((n * 2 + 1).alias("record_id"), url.alias("url"), (n * 10 + 75).alias("at"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
                           F.when(n % 5 == 0, F.lit('"other"')).when(n % 3 != 0, F.concat(F.lit("W/"), tag)).alias("etag"), date.alias("modified"),
                           headers(Date=F.lit("later"), Server=F.lit("b"), Expires=F.lit("never")).alias("headers"), F.lit(None).cast("string").alias("body"))
    return response.unionByName(revisit)
