"""WARC archives with revisit records: identical payloads are stored once, and every later capture refers to the first.

Only headers (id, uri, size, digest) are shuffled by payload digest to find the original of each payload; the records that become revisits are
a small table that meets the records once, by record key.  Archives are then written anew: one gzip member a record, fresh record ids and
dates, ``warcinfo`` first in each file.

Archives are written by Spark's text writer, so they appear under its commit protocol in any store that Spark reaches, and a lost task is
written again.  A row of that writer is a run of whole gzip members without its last byte, which is 0 (the high byte of a member's length),
and the line separator is that byte; so files hold nothing but members.  Files end in ``.txt``, which is the writer's choice.

Defined results: a null payload is empty; a null uri has no header and is read back as null; control characters in a uri are written as
``%XX``; a null id comes after all others, and where the original has none, ``refers_to`` is null; of records that share the least id and the
payload, the one with the least uri is the original, and of wholly equal rows exactly one is; payloads below ``least`` bytes are never
revisits; a revisit record that comes in without its original stays a revisit without a reference; an empty table gives no archives and an
empty result; other columns, whatever their names, are not read.  An archive that breaks off gives its records before the fault and a row
with ``error``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.storage import materialize, shared_dir

LEAST = 100
SALTS = 16
BLOCK = 4 << 20
BLOCKS_A_FILE = 16
#: a gzip member without contents
_NOTHING = gzip.compress(b"", mtime=0)
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "record_id string, record_type string, id bigint, uri string, date string, stated_digest string, refers_to_record string, refers_to_uri string, payload_bytes bigint, payload_digest string, error string"


def record_key(id_: Column, uri: Column, digest: Column) -> Column:
    """A key of a record: equal for rows that agree in id, uri and payload, and for no others."""
    return F.sha2(F.concat_ws("\x1f", F.coalesce(id_.cast("string"), F.lit("-")), F.when(uri.isNull(), "-").otherwise(F.concat(F.lit("+"), uri)), digest), 256)


def records_of(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Response records (key, id, uri, record_type, size, digest, payload) of a table with one row a capture."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(uri_col).alias("uri"), body.alias("payload"))
    rows = rows.select("id", "uri", F.lit("response").alias("record_type"), F.octet_length("payload").cast("bigint").alias("size"), F.sha2("payload", 256).alias("digest"), "payload")
    return rows.withColumn("key", record_key(F.col("id"), F.col("uri"), F.col("digest")))


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """Join rows to those of a side with one row a key, each of which stands under ``SALTS`` salts; ``by`` tells the many rows of a key apart."""
    spread = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(spread, [*keys, "_salt"], how).drop("_salt")


def resolve(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """Return the records that share their payload with another one, a row for each key: key, n (rows of it), own (whether they hold the
    original) and the original's key, id and uri.

    headers: key, id, uri, record_type, size, digest.  Counting and choosing originals is combined before the shuffle; the originals of
    repeated payloads are spread over salts to meet their records, so a payload that a third of all records share has many tasks.
    """
    known = headers.groupBy("key", "id", "uri", "record_type", "size", "digest").agg(F.count("*").alias("n"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("uri").isNull().alias("no_uri"), "uri", "key")
    groups = known.groupBy("digest").agg(F.min(F.when(F.col("record_type") == "response", rank)).alias("first"), F.sum("n").alias("all")).where("all > 1 AND first IS NOT NULL")
    met = salted_join(known.where((F.col("size") >= least) | (F.col("record_type") == "revisit")), groups.select("digest", "first"), ["digest"], "key")
    return met.select("key", "n", (F.col("first.key") == F.col("key")).alias("own"), F.col("first.key").alias("first_key"), F.col("first.id").alias("first_id"), F.col("first.uri").alias("first_uri"))


def decided(records: DataFrame, least: int = LEAST) -> DataFrame:
    """Give each record its type and, for revisits, the original (first_key, first_id, first_uri); revisits lose their payload.

    Of wholly equal rows that hold the original one stays a response: they are counted before they are shuffled, and unfolded again.
    """
    shared = materialize(resolve(records.drop("payload"), least), "warc-shared")
    tied = shared.where("own AND n > 1").select("key")
    ties = not tied.isEmpty()
    plain = records.join(tied, "key", "left_anti") if ties else records
    again = shared.where("NOT own").select("key", "first_key", "first_id", "first_uri")
    joined = plain.join(again, "key", "left")
    revisit = F.col("first_key").isNotNull() | (F.col("record_type") == "revisit")
    out = joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("payload", F.when(~revisit, F.col("payload")))
    if not ties:
        return out
    one = records.join(tied, "key", "left_semi").groupBy("key", "id", "uri", "record_type", "size", "digest").agg(F.count("*").alias("n"), F.first("payload").alias("payload"))
    each = one.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    first = F.col("k") == 1
    equal = each.select(
        "key", "id", "uri", F.when(first, "response").otherwise("revisit").alias("record_type"), "size", "digest", F.when(first, F.col("payload")).alias("payload"),
        F.when(~first, F.col("key")).alias("first_key"), F.when(~first, F.col("id")).alias("first_id"), F.when(~first, F.col("uri")).alias("first_uri"),
    )
    return out.unionByName(equal.select(out.columns))


def record_id(key: str) -> str:
    """The record id of a key: an UUID made from it."""
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(key.encode()).hexdigest()[:32])}>"


def _field(text: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _head(kind: str, fields: list[tuple[str, object]], block: int) -> bytes:
    shown = [("WARC-Type", kind), *((k, v) for k, v in fields if v is not None), ("Content-Length", block)]
    return (f"{_VERSION}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in shown) + "\r\n").encode()


def _member(kind: str, fields: list[tuple[str, object]], parts: tuple[bytes, ...], level: int) -> bytes:
    """One record as one gzip member, closed by an empty one if it is so long that its last byte is not 0."""
    size = sum(map(len, parts))
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = _head(kind, fields, size)
    made = [packer.compress(x) for x in (head, *parts, b"\r\n\r\n")]
    out = b"".join([*made, packer.flush()])
    return out if out[-1] == 0 else out + _NOTHING


def _response(id_: int | None, uri: str | None, digest: str, key: str, date: str, payload: bytes, level: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Record-ID", record_id(key)), ("WARC-Date", date), ("WARC-Target-URI", uri and _field(uri)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Capture-Id", id_), ("Content-Type", "application/http; msgtype=response")]
    return _member("response", fields, (http, payload), level)


def _revisit(id_: int | None, uri: str | None, digest: str, own: str, date: str, first: str | None, first_uri: str | None, level: int) -> bytes:
    refers = [("WARC-Refers-To", first and record_id(first)), ("WARC-Refers-To-Target-URI", first_uri and _field(first_uri))]
    fields = [("WARC-Record-ID", record_id(own)), ("WARC-Date", date), ("WARC-Target-URI", uri and _field(uri)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Profile", _REVISIT), *refers, ("X-Capture-Id", id_), ("Content-Type", "application/http; msgtype=response")]
    return _member("revisit", fields, (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n",), level)


def write_archives(records: DataFrame, path: str, level: int = 6, date: str | None = None) -> None:
    """Write decided records as archives below ``path``: files of about ``BLOCK * BLOCKS_A_FILE`` bytes, or one longer record.

    The date is the same for all, so a task that runs again writes the same bytes.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, blocks, made, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def block() -> pa.RecordBatch:
            if blocks % BLOCKS_A_FILE == 0:
                about = b"software: turnloom\r\nformat: WARC File Format 1.1\r\n"
                made.insert(0, _member("warcinfo", [("WARC-Record-ID", record_id(f"info/{date}/{task}/{blocks}")), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], (about,), level))
            data = b"".join(made)[:-1]
            # not text: the bytes go through as they are
            value = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int32).tobytes()), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([value], names=["value"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "id", "uri", "digest", "record_type", "first_key", "first_uri")]
            payloads = batch.column("payload")
            for k, (key, id_, uri, digest, kind, first, first_uri) in enumerate(zip(*columns, strict=True)):
                if kind == "response":
                    made.append(_response(id_, uri, digest, key, date, payloads[k].as_py() or b"", level))
                else:
                    made.append(_revisit(id_, uri, digest, f"{key}/{task}/{rows}", date, first, first_uri, level))
                rows, size = rows + 1, size + len(made[-1])
                if size >= BLOCK:
                    yield block()
                    made, size, blocks = [], 0, blocks + 1
        if made:
            yield block()

    slim = records.select("key", "id", "uri", "digest", "record_type", "first_key", "first_uri", "payload")
    slim.mapInArrow(run, "value string").write.option("lineSep", "\x00").option("encoding", "ISO-8859-1").option("maxRecordsPerFile", BLOCKS_A_FILE).text(path)


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, whether it is packed or not."""
    source = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 18) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the beginning of a record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = source.read(size)
        if len(block) < size:
            raise ValueError("the archive breaks off within a record")
        yield fields, block


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    http = fields.get("content-type", "").startswith("application/http")
    body = block.partition(b"\r\n\r\n")[2] if http else block
    own = None if kind == "revisit" else hashlib.sha256(body).hexdigest()
    id_ = fields.get("x-capture-id")
    head = (fields.get("warc-record-id"), kind, None if id_ is None else int(id_), fields.get("warc-target-uri"), fields.get("warc-date"), stated, fields.get("warc-refers-to"), fields.get("warc-refers-to-target-uri"))
    return (*head, None if kind == "revisit" else len(body), own, None, None if kind == "revisit" else body)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All response and revisit records below ``path`` with size and digest of the payloads as they are there, and, if asked for, the payloads.

    An archive is one row of Spark's binary source (at most 2 GB), unpacked record by record.
    """
    schema = READ + ", payload binary" * payloads
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

        for part in batches:
            for k in range(part.num_rows):
                rows, size = [], 0
                try:
                    for head, block in _records(part.column("content")[k].as_py()):
                        if head.get("warc-type") in ("response", "revisit"):
                            rows.append(_row(head, block))
                            size += len(block) if payloads else 300
                            if size >= BLOCK:
                                yield batch(rows)
                                rows, size = [], 0
                except (ValueError, KeyError, EOFError, OSError, zlib.error) as e:
                    rows.append((*[None] * 10, f"{part.column('path')[k].as_py()}: {type(e).__name__}: {e}", None))
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def resolved(read: DataFrame) -> DataFrame:
    """Join the revisit records of archives to their originals: id, payload_bytes, payload_digest, record_type, refers_to (the original's id).

    A revisit whose original is not there, or has another payload than it says, refers to nothing and has the digest it states.  Originals
    are few beside responses; they are found first, and spread over ``SALTS`` keys.
    """
    good = read.where("error IS NULL")
    responses, revisits = good.where("record_type = 'response'"), good.where("record_type = 'revisit'")
    wanted = revisits.where("refers_to_record IS NOT NULL").select(F.col("refers_to_record").alias("record_id")).distinct()
    firsts = responses.join(wanted, "record_id", "left_semi").select(F.col("record_id").alias("refers_to_record"), F.col("payload_digest").alias("stated_digest"), F.col("id").alias("refers_to"), F.col("payload_bytes").alias("first_bytes"))
    # without a reference a revisit's own id stands in as the key, so such records do not gather
    met = salted_join(revisits.withColumn("refers_to_record", F.coalesce("refers_to_record", "record_id")), firsts, ["refers_to_record", "stated_digest"], "record_id", "left")
    out = met.select("id", F.col("first_bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest"), "record_type", "refers_to")
    return responses.select("id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to")).unionByName(out)


def deduplicate(records: DataFrame, path: str, least: int = LEAST, level: int = 6) -> DataFrame:
    """Write records as archives that hold each payload once, and return what the archives hold, without payloads."""
    write_archives(decided(records, least), path, level)
    return read_archives(records.sparkSession, path)


def rewrite(spark: SparkSession, source: str, path: str, least: int = LEAST, level: int = 6) -> DataFrame:
    """Write archives anew with revisits resolved over all of them, and return what the new ones hold.

    Revisit records of the source keep their digest and refer to the new record of their original.
    """
    read = read_archives(spark, source, payloads=True).where("error IS NULL")
    responses, revisits = read.where("record_type = 'response'"), read.where("record_type = 'revisit'")
    # other archives may state another kind of digest, which their responses translate
    stated = responses.where("stated_digest IS NOT NULL AND stated_digest <> payload_digest").groupBy("stated_digest").agg(F.min("payload_digest").alias("known"))
    again = salted_join(revisits.withColumn("stated_digest", F.coalesce("stated_digest", "record_id")), stated, ["stated_digest"], "record_id", "left")
    again = again.select("id", "uri", "record_type", F.lit(0).cast("bigint").alias("size"), F.coalesce("known", "stated_digest").alias("digest"), "payload")
    rows = responses.select("id", "uri", "record_type", F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest"), "payload").unionByName(again)
    key = record_key(F.col("id"), F.col("uri"), F.col("digest"))
    return deduplicate(rows.withColumn("key", F.when(F.col("record_type") == "revisit", F.concat(key, F.lit("/revisit"))).otherwise(key)), path, least, level)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as deduplicated archives, read them back and resolve the revisits."""
    path = f"{shared_dir(spark)}/turnloom/warc-{uuid.uuid4().hex}"
    read = deduplicate(records_of(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    kept = materialize(read, "warc-headers")
    return resolved(kept).withColumnRenamed("id", "page_id")


ORACLE = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.*, CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND p.payload_bytes >= 100
"""
