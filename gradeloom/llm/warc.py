"""Deterministic sharded WARC writer and reader.

Pages are dealt over shards by id and sorted by id within.  Shard bounds follow the rows: the exact global order
of ids is cut into ranges of about equally many rows, and each range into as many shards of equal width as its
bytes need, so sparse ids or a far outlier leave no shard with most of the pages.  Pages without an id are dealt
by digest; rows of one id stay together.  A shard is a run of files, each closed before its compressed size would pass ``roll_bytes`` (a larger record has a file of its own).
Records are single gzip members with regenerated headers and digests and a given date, so the bytes
depend on the rows alone.  Every task writes under a temporary name of its own and reports it; the
reports are written as a table, and only files named there are renamed, again in tasks, and listed in the
manifest, which appears last.  Files of lost or repeated tasks are never named.

Of pages with equal payloads of at least ``least_bytes``, the one with the smallest id (nulls last, the
first of repeated rows) is a response and the others are revisits of it.  A null html is an empty
payload, a null url gives no target header, a null id sorts behind all others.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.ordered import ranked_rows
from gradeloom.llm.common import fresh_path, text_batches, written

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_MANIFEST.json"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all machines see, and the folder's path there."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}/{digest}/{nth}'.encode()).digest())}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, nth: int, revisit: bool, refers_to: int | None, date: str) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    target = None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest, nth)),
               ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
               ("WARC-Profile", REVISIT if revisit else None),
               ("WARC-Refers-To", record_id(refers_to, digest, 0) if revisit else None),
               ("X-Refers-To-Page", refers_to if revisit else None), ("X-Page", page_id),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def shard_of(narrow: DataFrame, shard_bytes: int, most_ranges: int = 1024) -> tuple[Column, int]:
    """The shard of a row of ``narrow(page_id, digest, size)`` and the number of shards; depends on the rows alone.

    At most ``most_ranges`` bounds and sums reach the driver.
    """
    # a mark of its own for every row spreads a frequent id; which of its rows comes first changes no bound
    ids = narrow.where("page_id is not null").select("page_id", F.monotonically_increasing_id().alias("mark"))
    whole = narrow.agg(F.sum("size").alias("size"), F.count("page_id").alias("ids")).first()
    ranges = min(most_ranges, max(1, -(-(whole["size"] or 0) // shard_bytes)), max(1, whole["ids"]))
    lows = []
    if whole["ids"]:
        step = -(-whole["ids"] // ranges)
        cuts = ranked_rows(ids, [F.col("page_id"), F.col("mark")], "position").where(F.col("position") % step == 0) if ranges > 1 else ids.agg(F.min("page_id").alias("page_id"))
        lows = sorted({r["page_id"] for r in cuts.select("page_id").distinct().collect()})
    at = F.size(F.filter(F.array(*[F.lit(low).cast("long") for low in lows]), lambda low: low <= F.col("page_id"))) - 1 if lows else F.lit(None).cast("int")
    place = F.when(F.col("page_id").isNotNull(), at)
    sums = {r["at"]: r for r in narrow.groupBy(place.alias("at")).agg(F.sum("size").alias("size"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).collect()}
    parts = {k: max(1, round((r["size"] or 0) / shard_bytes)) for k, r in sums.items()}
    known, first = sorted(k for k in sums if k is not None), 0
    bases, counts, starts, widths = [], [], [], []
    for k in range(len(lows)):
        n = parts.get(k, 1)
        bases.append(first)
        counts.append(n)
        starts.append(float(lows[k]))
        widths.append(max(1.0, (float(sums[k]["hi"]) - float(lows[k]) + 1) / n) if k in known else 1.0)
        first += n

    def of(values, kind):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), at)

    without = first + F.pmod(F.xxhash64("digest"), F.lit(parts.get(None, 1)))
    if not lows:
        return without.cast("int"), first + parts.get(None, 1)
    inside = F.floor((F.col("page_id").cast("double") - of(starts, "double")) / of(widths, "double"))
    numbered = of(bases, "long") + F.least(inside, of(counts, "long") - 1)
    return F.when(F.col("page_id").isNull(), without).otherwise(numbered).cast("int"), first + parts.get(None, 0)


def write(pages: DataFrame, folder: str, *, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 100,
          shard_bytes: int = 16 << 20, roll_bytes: int = 8 << 20, level: int = 4) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives into the new ``folder``; gives the manifest rows."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    narrow = own.select("page_id", "digest", F.octet_length("html").alias("size"))
    shard, shards = shard_of(narrow, shard_bytes)

    copies = (narrow.where(F.col("size") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    notes = narrow.where(F.col("size") >= least_bytes).select("page_id", "digest").distinct().join(copies, "digest")
    none = F.lit(None).cast("string")
    rows = (notes.select("page_id", none.alias("url"), none.alias("html"), "digest", F.col("first"), F.lit(0).alias("kind"))
            .unionByName(own.withColumn("first", F.lit(None).cast("long")).withColumn("kind", F.lit(1)))
            .withColumn("shard", shard))
    final, temporary = folder.rstrip("/"), f"{folder.rstrip('/')}/_temporary"
    system, root = filesystem(final)
    system.create_dir(f"{root}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(temporary)
        done: list[tuple] = []
        stream = sha = None
        at: dict = {}

        def close() -> None:
            nonlocal stream
            if stream is not None:
                stream.close()
                done.append((at["shard"], at["roll"], at["temp"], at["records"], at["bytes"], sha.hexdigest()))
                stream = None

        current, key, first, nth, noted = None, None, None, 0, False
        for batch in text_batches(batches, "html"):
            for row in batch.to_pylist():
                if row["shard"] != current:
                    close()
                    current, at = row["shard"], {"shard": row["shard"], "roll": -1}
                if key != (row["page_id"], row["digest"]):
                    key, first, nth, noted = (row["page_id"], row["digest"]), None, 0, False
                if row["kind"] == 0:
                    first, noted = row["first"], True
                    continue
                payload = row["html"].encode()
                revisit = noted and (first != row["page_id"] or nth > 0)
                member = zlib.compressobj(level, wbits=31)
                data = record(row["page_id"], row["url"], payload, row["digest"], nth, revisit, first, date)
                data = member.compress(data) + member.flush()
                nth += 1
                if stream is None or at["bytes"] + len(data) > roll_bytes:
                    close()
                    at = {"shard": current, "roll": at["roll"] + 1, "temp": uuid.uuid4().hex, "records": 0, "bytes": 0}
                    stream, sha = system.open_output_stream(f"{base}/{at['temp']}"), hashlib.sha256()
                stream.write(data)
                sha.update(data)
                at["records"] += 1
                at["bytes"] += len(data)
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
            ["shard", "roll", "temp", "records", "bytes", "sha256"])

    order = [F.col("shard"), F.col("page_id").asc_nulls_last(), F.col("digest"), F.col("kind"), F.col("url").asc_nulls_last()]
    # by range, with more ranges than shards, so that every shard is a range of its own and no task gets two
    written_files = (rows.repartitionByRange(2 * max(1, shards), "shard").sortWithinPartitions(*order)
                     .select("shard", "page_id", "digest", "kind", "first", "url", "html")
                     .mapInArrow(run, "shard int, roll int, temp string, records long, bytes long, sha256 string"))
    manifest = written(written_files, "warc-manifest").withColumn("name", F.format_string("part-%05d-%05d.warc.gz", "shard", "roll"))
    _commit(manifest, final)
    return manifest.select("name", "records", "bytes", "sha256", F.concat(F.lit(final + "/"), "name").alias("path"))


def _commit(manifest: DataFrame, folder: str) -> None:
    """Rename the files that the finished tasks name, in tasks of a share of the shards each, then let the manifest appear.

    Can be repeated, as a whole or by any task: a file that already has its name is left alone.  The driver streams the
    manifest's rows, a partition at a time, and renames nothing but the manifest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        for batch in batches:
            for name, temp in zip(batch.column("name").to_pylist(), batch.column("temp").to_pylist()):
                target = f"{root}/{name}"
                if system.get_file_info(target).type == pafs.FileType.NotFound:
                    try:
                        system.move(f"{root}/_temporary/{temp}", target)
                    except OSError:
                        # another attempt of this task may have been first
                        if system.get_file_info(target).type == pafs.FileType.NotFound:
                            raise
            yield batch

    cells = "name string, records long, bytes long, sha256 string, temp string"
    spark = manifest.sparkSession
    tasks = max(1, min(manifest.count(), spark.sparkContext.defaultParallelism * 4))
    named = written(manifest.select("name", "records", "bytes", "sha256", "temp").repartition(tasks, "name").mapInArrow(run, cells), "warc-named")
    system, root = filesystem(folder)
    with system.open_output_stream(f"{root}/{MANIFEST}.tmp") as out:
        for row in named.orderBy("name").toLocalIterator():
            out.write(json.dumps({k: row[k] for k in ("name", "records", "bytes", "sha256")}).encode() + b"\n")
    system.move(f"{root}/{MANIFEST}.tmp", f"{root}/{MANIFEST}")
    system.delete_dir(f"{root}/_temporary")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    data, inflate, parts = b"", zlib.decompressobj(wbits=31), []
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if parts:
                raise ValueError("archive ends within a record")
            return
        parts.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(wbits=31), []


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (and the length that the HTTP header tells, as ``payload``) and payload; digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block digest differs in {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    headers["payload"] = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:]
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise ValueError(f"payload digest differs in {headers['WARC-Record-ID']}")
    return headers, payload


def read(spark: SparkSession, files: DataFrame, *, payloads: bool = True) -> DataFrame:
    """One row per record of ``files(path)``: page, target, type, digest, and the payload of responses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = filesystem(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    held, size = [], 0
                    for data in members(stream):
                        headers, payload = parsed(data)
                        number = lambda k, h=headers: int(h[k]) if k in h else None
                        held.append((number("X-Page"), headers.get("WARC-Target-URI"), int(headers["payload"]), headers["WARC-Payload-Digest"][7:],
                                     headers["WARC-Type"], number("X-Refers-To-Page"), payload if payloads and headers["WARC-Type"] == "response" else None))
                        size += len(payload) if payloads else 100
                        if size > 4 << 20:
                            yield as_batch(held)
                            held, size = [], 0
                    yield as_batch(held)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["page_id", "target", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    tasks = max(1, min(files.count(), spark.sparkContext.defaultParallelism * 4))
    return (files.select("path").repartition(tasks, "path")
            .mapInArrow(run, "page_id long, target string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"))


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write the pages to a fresh archive folder and read it back."""
    spark = pages.sparkSession
    return read(spark, write(pages, fresh_path(spark, "warc"), **how), payloads=False).drop("payload")
