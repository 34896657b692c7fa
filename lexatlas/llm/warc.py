"""WARC records, and not-modified revisits resolved against earlier captures.

A revisit record stores that a server answered 304: headers, no body. It is resolved by an as-of join: of the full responses of the
same canonical URL, the latest that was captured before it. Validators are then checked, the strongest that both have: payload
digest, entity tag (weak comparison), date of last modification. If they agree the revisit gets the response's payload and its
headers, with those that a 304 may update taken from the revisit.

status of a revisit: `resolved`; `unchecked` (an earlier response, no validator in common; resolved too); `changed` (the validators
differ, so the payload isn't the earlier one); `missing` (no earlier response, or no URL). Responses are `full`; others `other`.

The join is skew-proof: records are sorted by ranges of (URL, date, id), so the records of one URL spread over many partitions. Each
partition finds its own latest responses in a window by (partition, URL); the last response before a partition's first URL comes
from a table with one row a partition. Edge cases: records of equal date are in order of their id; a response counts as earlier only
if it comes before in that order. Repeated records are each kept. Null headers are empty. A null url is `missing`. Broken WARC
bytes give the records before the break, a payload that can't be decoded stays as it is; null bytes have no records. Other columns stay unread and may have any names.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.llm.common import ready_python, staged, table

#: Headers of a 304 that replace the stored ones (RFC 9110, 15.4.5), and query parameters that don't name a resource.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(?:utm_[^=]*|fbclid|gclid|ref|sessionid|phpsessid|jsessionid)(?:=|$)"

RECORD = "record_id string, type string, url string, date string, headers map<string,string>, digest string, payload binary"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without a last slash, other query parameters sorted; no scheme, no
    fragment. Null if there is no host."""
    parts = lambda k: F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)([^?#]*)\??([^#]*)", k)
    host = F.regexp_replace(F.regexp_replace(F.lower(parts(1)), r":(?:80|443)$", ""), r"^www\.", "")
    query = F.array_join(F.array_sort(F.filter(F.split(parts(3), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))), "&")
    whole = F.concat(host, F.regexp_replace(parts(2), r"/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", whole)


def write_record(kind: str, record_id: str, url: str | None, date: str, headers: dict[str, str], payload: bytes | None, status: str = "200 OK") -> bytes:
    http = f"HTTP/1.1 {status}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    block = http.encode() + (payload or b"")
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    if url is not None:
        fields["WARC-Target-URI"] = url
    if payload is not None:
        fields["WARC-Payload-Digest"] = "sha256:" + hashlib.sha256(payload).hexdigest()
    if kind == "revisit":
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            name = name.strip().lower()
            out[name] = f"{out[name]}, {value.strip()}" if name in out else value.strip()
    return out


def _body(headers: dict[str, str], body: bytes) -> bytes:
    if "chunked" in headers.get("transfer-encoding", "").lower():
        out, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0:
            size = int(body[at:end].split(b";")[0] or b"0", 16)
            if size < 0:
                raise ValueError("a chunk of negative size")
            if not size:
                break
            out.append(body[end + 2 : end + 2 + size])
            at = end + 2 + size + 2
        body = b"".join(out)
    if headers.get("content-encoding", "").lower() in ("gzip", "x-gzip"):
        body = gzip.decompress(body)
    elif headers.get("content-encoding", "").lower() == "deflate":
        body = zlib.decompress(body)
    return body


def _members(data: bytes) -> bytes:
    """What gzip members hold, one after another, up to the first broken byte."""
    out: list[bytes] = []
    while data[:2] == b"\x1f\x8b":
        member, rest = zlib.decompressobj(31), memoryview(data)
        try:
            while len(rest) and not member.eof:
                out.append(member.decompress(rest[:65536]))
                rest = rest[65536:]
        except zlib.error:
            break
        if not member.eof:
            break
        data = member.unused_data + bytes(rest)
    return b"".join(out)


def parse(data: bytes | None) -> Iterator[tuple]:
    """The records of WARC bytes, gzipped or not, as tuples of RECORD."""
    data = data or b""
    if data[:2] == b"\x1f\x8b":
        data = _members(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        f = _fields(data[at:end])
        try:
            size = int(f.get("content-length", ""))
        except ValueError:
            return
        if size < 0:
            return
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            return
        at = end + 4 + size
        headers, payload = {}, block
        if f.get("content-type", "").startswith("application/http"):
            head, _, rest = block.partition(b"\r\n\r\n")
            headers = _fields(head)
            try:
                payload = _body(headers, rest)
            except (ValueError, OSError, zlib.error, EOFError):
                payload = rest
        kind = f.get("warc-type", "")
        yield f.get("warc-record-id", "").strip("<>"), kind, f.get("warc-target-uri"), f.get("warc-date"), headers, f.get("warc-payload-digest"), payload if kind != "revisit" else None


def read_warc(df: DataFrame, *, warc_col: str = "warc") -> DataFrame:
    """The records (RECORD) of a column of WARC bytes."""
    ready_python(df.sparkSession)
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                rows = [r for x in b.column(0).slice(k, 256) for r in parse(x.as_py())]
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                cols[4] = [list(m.items()) for m in cols[4]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return df.select(warc_col).mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records: record_id, type, url, date (sortable), headers, digest, and size and sha256 of the payload. One row per record:
    record_id, type, canonical_url, status, source_id (the response it was resolved to), headers (merged), size, sha256."""
    text = F.col("headers")
    r = records.select(
        "record_id", "type", "date", "digest", "size", "sha256", canonical_url(F.col("url")).alias("canonical_url"), F.coalesce(text, F.create_map().cast("map<string,string>")).alias("headers")
    )
    full = F.when(F.col("type") == "response", F.struct("record_id", "digest", "headers", "size", "sha256"))
    order = ["canonical_url", "date", "record_id"]
    parts = r.withColumn("full", full).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    parts = staged(parts, "warc-sorted")
    # the last response of each partition's last URL, carried to the partitions that go on with that URL
    ends = parts.groupBy("part").agg(F.min("canonical_url").alias("first"), F.max("canonical_url").alias("last"))
    tails = parts.where("full is not null").groupBy("part", "canonical_url").agg(F.max_by("full", F.struct("date", "record_id")).alias("tail"))
    tails = ends.join(tails.withColumnRenamed("canonical_url", "last"), ["part", "last"], "left").select("part", F.col("last").alias("u"), "tail", F.lit(True).alias("is_tail"))
    heads = ends.select("part", F.col("first").alias("u"), F.lit(None).cast(tails.schema["tail"].dataType).alias("tail"), F.lit(False).alias("is_tail"))
    # tails of earlier partitions only: a head sorts before the tail of its own
    carry = F.last("tail", ignorenulls=True).over(W.partitionBy("u").orderBy("part", "is_tail").rowsBetween(W.unboundedPreceding, W.currentRow))
    carried = heads.unionByName(tails).withColumn("carried", carry).where("not is_tail").select("part", F.col("u").alias("canonical_url"), "carried").where("carried is not null")
    before = W.partitionBy("part", "canonical_url").orderBy("date", "record_id").rowsBetween(W.unboundedPreceding, -1)
    found = parts.withColumn("own", F.last("full", ignorenulls=True).over(before)).join(staged(carried, "warc-carried"), ["part", "canonical_url"], "left")
    at = F.when(F.col("canonical_url").isNotNull(), F.coalesce("own", "carried"))
    found = found.withColumn("at", F.when(F.col("type") == "revisit", at))

    tag = lambda h: F.regexp_replace(h["etag"], r"^W/", "")
    mine, old = F.col("headers"), F.col("at.headers")
    same = F.coalesce(F.col("digest") == F.col("at.digest"), tag(mine) == tag(old), mine["last-modified"] == old["last-modified"])
    status = (
        F.when(F.col("type") == "response", "full").when(F.col("type") != "revisit", "other").when(F.col("at").isNull(), "missing").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("changed")
    )
    found = found.withColumn("status", status)
    good = F.col("status").isin("resolved", "unchecked")
    update = F.map_filter(mine, lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    pick = lambda c: F.when(good, F.col(f"at.{c}")).when(F.col("type") != "revisit", F.col(c))
    return found.select(
        "record_id", "type", "canonical_url", "status", F.when(good, F.col("at.record_id")).alias("source_id"), F.when(good, merged).otherwise(mine).alias("headers"), pick("size").alias("size"), pick("sha256").alias("sha256")
    )


def pages_to_warc(pages: DataFrame, *, delay: int = 1000) -> DataFrame:
    """A crawl of `pages` as WARC bytes, a row each: the page's response at second 4 * page_id, and `delay` pages later a conditional
    request that the server answers with not-modified and the entity tag of this page."""
    ready_python(pages.sparkSession)

    def moment(second: int) -> str:
        return datetime.fromtimestamp(1_600_000_000 + second, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                out = []
                for page, url, html in zip(*(b.column(i).slice(k, 256).to_pylist() for i in range(3)), strict=True):
                    body, at = (html or "").encode(), 4 * (page or 0)
                    tag = '"' + hashlib.md5(body, usedforsecurity=False).hexdigest() + '"'
                    full = {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(body)), "ETag": tag, "Date": moment(at)}
                    later = {"Content-Length": "0", "ETag": f"W/{tag}", "Date": moment(at + 4 * delay + 2), "Cache-Control": "max-age=60"}
                    out.append(write_record("response", f"urn:page:{page}:a", url, moment(at), full, body) + write_record("revisit", f"urn:page:{page}:b", url, moment(at + 4 * delay + 2), later, None, "304 Not Modified"))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["warc"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "warc binary")


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(pages_to_warc(table(spark, sf_dir, "pages")))
    records = records.select("record_id", "type", "url", "date", "headers", "digest", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("sha256"))
    done = resolve_revisits(records)
    return done.select(
        "record_id", "type", "canonical_url", "status", "source_id", F.col("headers")["etag"].alias("etag"), F.col("headers")["content-length"].alias("content_length"),
        F.size("headers").cast("long").alias("n_headers"), F.col("size").alias("payload_bytes"), F.col("sha256").alias("payload_sha256"),
    )


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)([^?#]*)\??([^#]*)', ['host', 'path', 'query']) AS u FROM pages
), c AS (
  SELECT page_id, html, regexp_replace(regexp_replace(lower(u.host), ':(80|443)$', ''), '^www\.', '') AS host, regexp_replace(u.path, '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(utm_[^=]*|fbclid|gclid|ref|sessionid|phpsessid|jsessionid)(=|$)'))), '&') AS query FROM p
), k AS (
  SELECT page_id, CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS url,
    '"' || md5(html) || '"' AS tag, strlen(html)::BIGINT AS n, sha256(html) AS sha FROM c
), r AS (
  SELECT 'urn:page:' || page_id || ':a' AS record_id, 'response' AS type, url, tag, n, sha, 4 * page_id AS moment FROM k
  UNION ALL SELECT 'urn:page:' || page_id || ':b', 'revisit', url, tag, n, sha, 4 * page_id + 4002 FROM k
), f AS (
  SELECT *, last_value(CASE WHEN type = 'response' THEN {'id': record_id, 'tag': tag, 'n': n, 'sha': sha} END IGNORE NULLS)
    OVER (PARTITION BY url ORDER BY moment, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS full_one FROM r
), g AS (
  SELECT *, CASE WHEN type = 'response' THEN 'full' WHEN url IS NULL OR full_one IS NULL THEN 'missing' WHEN full_one.tag = tag THEN 'resolved' ELSE 'changed' END AS status FROM f
)
SELECT record_id, type, url AS canonical_url, status, CASE WHEN status = 'resolved' THEN full_one.id END AS source_id,
  CASE WHEN type = 'response' THEN tag ELSE 'W/' || tag END AS etag,
  CASE WHEN type = 'response' THEN n::VARCHAR WHEN status = 'resolved' THEN full_one.n::VARCHAR ELSE '0' END AS content_length,
  CASE WHEN status = 'resolved' THEN 5 ELSE 4 END::BIGINT AS n_headers,
  CASE WHEN type = 'response' THEN n WHEN status = 'resolved' THEN full_one.n END AS payload_bytes,
  CASE WHEN type = 'response' THEN sha WHEN status = 'resolved' THEN full_one.sha END AS payload_sha256
FROM g
"""
