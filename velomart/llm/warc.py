"""A deterministic sharded WARC writer and its reader.

Writing: records are range-sorted by page id and payload digest into shards (one exchange
of the payloads), which are as many as the payload bytes ask for.  The splitters come from a
sample that a hash of the record draws, weighed by bytes, so shards and files are the same
whatever the partitions or cores; ids that are null or repeated are cut between digests.  Of
the sample ``SAMPLE_KEYS`` keys a shard reach the driver.  A shard's task rolls its files by compressed size, each record being its own
gzip member, and regenerates record headers, block and payload digests.  A file is
written under a temporary name of its attempt and renamed when complete, so a lost or
repeated attempt leaves nothing that counts; the list of files, with sizes and digests,
becomes the manifest, written last.  Only files of a manifest are read.

Equal payloads of at least ``REVISIT_BYTES`` are stored once: the record of the smallest
page id is the response, the others are revisits that refer to it.  The decisions are
made on digests alone and meet the payloads inside the sort: a decision row is dealt by
the same key and sorts before its page.

Defined cases: a null payload is empty; a null url has no target header; line breaks in
a url are escaped; a row without a page id is always a response and never referred to;
of equal rows with one id the first is the response and the others revisit it; an empty
table gives an empty archive with a manifest of no files; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, scratch_folder, ship_package

REVISIT_BYTES = 100
ROLL_BYTES = 4 << 20  # a file is closed once it holds this many compressed bytes
SHARD_BYTES = 64 << 20  # payload bytes dealt to one shard, about
SAMPLE_KEYS = 64  # keys sampled for one shard
RECORD_BYTES = 512  # what a record weighs beside its payload
LEVEL = 6
STEP_BYTES = 1 << 14
#: Fixed values of the format: version, revisit profile and the names of the headers.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"  # stands in every record, so that reruns write the same bytes
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122

MANIFEST = "file string, records long, bytes long, sha256 string, first_page long, last_page long"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder given as URI or local path."""
    if ":/" in path:
        scheme, _, rest = path.partition(":")
        return pafs.FileSystem.from_uri(f"{scheme}://{'/' + rest.lstrip('/')}" if scheme == "file" else path)
    return pafs.LocalFileSystem(), path


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _headers(fields: list[tuple[str, object]]) -> bytes:
    return (VERSION + "\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record, uncompressed.  A revisit keeps the HTTP headers, which
    state the payload's length, and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields: list[tuple[str, object]] = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", RECORD_DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", refers_to)]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _headers(fields) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int) -> None:
        self.store, self.folder = open_store(folder)
        self.shard, self.number, self.out = shard, 0, None
        self.began = None  # page and digest of the last response that others revisit
        self.attempt = uuid.uuid4().hex[:8]
        self.store.create_dir(self.folder, recursive=True)

    def add(self, data: bytes, page_id: int | None) -> dict | None:
        """Appends a member; returns the manifest row of a file that this closes."""
        if self.out is None:
            self.name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_{self.name}.{self.attempt}.tmp"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.digest, self.size, self.records, self.first, self.last = hashlib.sha256(), 0, 0, page_id, page_id
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)
        self.records += 1
        self.last = page_id
        return self.close() if self.size >= ROLL_BYTES else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.number += 1
        self.store.move(self.temporary, f"{self.folder}/{self.name}")
        return {"file": self.name, "records": self.records, "bytes": self.size, "sha256": self.digest.hexdigest(), "first_page": self.first, "last_page": self.last}


def _write(folder: str):
    names = [part.split()[0] for part in MANIFEST.split(", ")]
    types = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(part.split()[0], types[part.split()[1]]) for part in MANIFEST.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, closed = None, []
        decided, refers = None, None  # page and digest of the last decision, and what it says
        for batch in batches:
            for row in range(batch.num_rows):
                shard, page_id, decision, digest, refers_to, url, html = (batch.column(c)[row].as_py() for c in ("shard", "page_id", "decision", "digest", "refers_to", "url", "html"))
                if decision:
                    decided, refers = (page_id, digest), refers_to
                    continue
                if roller is None or roller.shard != shard:
                    closed.append(roller.close() if roller else None)
                    roller = _Roller(folder, shard)
                target = refers if decided == (page_id, digest) else None
                if target is not None and target == page_id and not roller.began == decided:
                    target, roller.began = None, decided
                closed.append(roller.add(member(record(page_id, url, html or b"", digest, target)), page_id))
        if roller is not None:
            closed.append(roller.close())
        rows = [x for x in closed if x]
        yield pa.RecordBatch.from_pydict({n: [x[n] for x in rows] for n in names}, schema=schema)

    return run


def _order_key() -> Column:
    """A text that sorts as page id (null last) and digest do."""
    biased = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.when(F.col("page_id").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), biased)), F.col("digest"))


def _splitters(small: DataFrame, shards: int, rows: int) -> np.ndarray:
    """The least key of each shard but the first, by cumulative bytes of a sample that a
    hash of the record draws; at most about ``SAMPLE_KEYS`` keys a shard are collected."""
    drawn = min(1.0, SAMPLE_KEYS * shards / max(1, rows))
    chance = F.pmod(F.xxhash64("page_id", "digest"), F.lit(1 << 40)) < int(drawn * (1 << 40))
    sample = small.where(chance).groupBy(_order_key().alias("key")).agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("weight")).toArrow()
    keys = np.array(sample["key"].to_pylist(), "S")
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], sample["weight"].to_numpy()[order]
    total = np.cumsum(weights)
    cuts = np.searchsorted(total, np.arange(1, shards) * (total[-1] / shards)) if len(keys) else np.zeros(0, np.int64)
    return np.unique(keys[cuts[(cuts > 0) & (cuts < len(keys))]])


def _shard_of(splitters: np.ndarray):
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, keys.to_numpy().astype("S"), "right").astype(np.int32))

    return F.pandas_udf(shard, "int")


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shards: int | None = None) -> str:
    """Writes the archive of ``pages`` to a new ``folder``; returns the path of its manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn("digest", F.sha2("html", 256))
    small = rows.select("page_id", "digest", F.length("html").cast("long").alias("bytes"))
    count, total = small.agg(F.count("*"), F.sum("bytes")).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // SHARD_BYTES))
    splitters = _splitters(small, shards, count)
    shared = small.where(f"bytes >= {REVISIT_BYTES} and page_id is not null")
    # One row for each digest that more than one row has; then one for each page that has it.
    repeated = shared.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    decisions = shared.select("page_id", "digest").distinct().join(repeated, "digest")
    nothing = {"url": F.lit(None).cast("string"), "html": F.lit(None).cast("binary")}
    records = decisions.withColumns(nothing | {"decision": F.lit(True)}).unionByName(
        rows.withColumns({"refers_to": F.lit(None).cast("long"), "decision": F.lit(False)})
    )
    ship_package(spark)
    shard = _shard_of(splitters)(_order_key()) if len(splitters) else F.lit(0)
    dealt = (
        records.withColumn("shard", shard)
        .repartitionById(len(splitters) + 1, "shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "digest", F.col("decision").desc(), "url")
        .select("shard", "page_id", "decision", "digest", "refers_to", "url", "html")
    )
    manifest = f"{folder}/manifest"
    map_batches(dealt, _write(f"{folder}/data"), MANIFEST).write.parquet(manifest)
    return manifest


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, one gzip member at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            # In small steps: what a step leaves unused is copied.
            step = view[at : at + STEP_BYTES]
            if not step:
                raise ValueError("a member is cut off")
            parts.append(unpacker.decompress(step))
            at += len(step) - len(unpacker.unused_data)
        text = b"".join(parts)
        head, _, rest = text.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"not a record: {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(fields["Content-Length"])]
        if "sha256:" + hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        yield fields, block


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_id string, payload binary"


def _read(with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("payload", pa.binary())])

    def row(fields: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        length = int(dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        number = lambda name: int(fields[name]) if name in fields else None
        return (number("X-Page-ID"), fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"], number("X-Refers-To-Page"), fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), payload if with_payload and fields["WARC-Type"] == "response" else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [row(*x) for x in parse(content.as_py())]
                cols = zip(*rows, strict=True) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the files that the manifest of ``folder`` names; digests are
    verified.  Files are read by Spark, one row of at most about ``ROLL_BYTES`` (or one
    longer record) each."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], RECORDS)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(f"{folder}/data")
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(manifest.select("file", "bytes", "sha256"), "file")
    whole = named.withColumn("content", F.when((F.length("content") == F.col("bytes")) & (F.sha2("content", 256) == F.col("sha256")), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("damaged file "), "path"))))
    return map_batches(whole.select("content"), _read(with_payload), RECORDS)


def archive_pages(pages: DataFrame, **columns) -> DataFrame:
    """Writes the pages to a new archive in the shared folder and reads it back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    write_archive(pages, folder, **columns)
    return read_archive(pages.sparkSession, folder)
