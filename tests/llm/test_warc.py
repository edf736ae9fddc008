"""Round trips of archives."""

import gzip
import hashlib
import os

import pyarrow as pa
import pytest
from conftest_llm import key
from pyspark.sql import functions as F
from velomart.llm import warc as W
from velomart.llm.common import scratch_folder

BIG = "<html>" + "equal payload " * 20 + "</html>"
PAGES = [
    (5, "http://a/5", BIG), (2, "http://a/2", BIG), (9, None, BIG), (9, None, BIG), (2, "http://b/2", BIG),
    (1, "http://a/1", "short"), (3, "http://a/3\r\nX-Evil: 1", "short"), (4, "http://ä/4?q=é", None), (6, "", ""),
    (None, "http://n/", BIG), (None, None, None), (7, "u", "ünï " * 30000), (8, "u", "<p>\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (5, "http://c/5", "another payload of the same page, long enough to count as one of a hundred bytes, really, it is that long"),
]
SCHEMA = "page_id long, url string, html string, digest string, shard int, decision string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1, "y") for p in PAGES], SCHEMA)


def want(pages):
    first, out, seen = {}, [], set()
    data = [(p, (h or "").encode()) for p, _, h in pages]
    for p, h in data:
        if len(h) >= 100 and p is not None:
            first[h] = min(first.get(h, p), p)
    for p, h in data:
        target = first.get(h) if p is not None else None
        if target == p and (p, h) not in seen:
            target = None
        seen.add((p, h))
        out.append((key(p), len(h), hashlib.sha256(h).hexdigest(), "response" if target is None else "revisit", key(target)))
    return sorted(out)


def test_round_trip(spark, pages, monkeypatch):
    folder = scratch_folder(spark, "warc")
    W.write_archive(pages.repartition(4), folder, shards=3)
    got = W.read_archive(spark, folder, with_payload=True).collect()
    assert sorted((key(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, key(r.refers_to)) for r in got) == want(PAGES)
    payloads = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
    assert all(bytes(r.payload) == payloads[r.payload_digest] for r in got if r.record_type == "response")
    ids = {r.record_id for r in got if r.record_type == "response"}
    assert all(r.refers_to_id in ids for r in got if r.record_type == "revisit")
    assert {r.url for r in got if r.page_id == 3} == {"http://a/3%0D%0AX-Evil: 1"}


def test_files_are_the_same_each_time(spark, pages):
    def files():
        folder = scratch_folder(spark, "warc")
        W.write_archive(pages.repartition(3), folder, shards=2)
        local = W.open_store(f"{folder}/data")[1]
        names = sorted(os.listdir(local))
        assert not [n for n in names if n.endswith(".tmp")]
        for name in names:
            if name.endswith(".warc.gz"):
                assert gzip.open(f"{local}/{name}").read().startswith(b"WARC/1.1\r\n")
        return {n: open(f"{local}/{n}", "rb").read() for n in names if n.endswith(".warc.gz")}

    first = files()
    assert first and first == files()


def many_pages(spark, count, parts):
    """Pages of which a third has no id and some ids repeat, with copies among them."""
    page = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.lit(77)).otherwise(F.col("id")).cast("long")
    html = F.concat(F.lit("<p>"), F.repeat(F.sha2((F.col("id") % 40_000).cast("string"), 256), (F.col("id") % 5 + 1).cast("int")))
    rows = spark.range(count).select(page.alias("page_id"), F.concat(F.lit("http://x/"), F.col("id").cast("string")).alias("url"), html.alias("html"))
    return rows.repartition(parts, F.xxhash64("url", F.lit(parts)))


def test_many_pages_give_the_same_files_from_other_partitions(spark):
    def files(parts, shuffled):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        folder = scratch_folder(spark, "warc")
        try:
            W.write_archive(many_pages(spark, 60_000, parts), folder, shards=12)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        rows = spark.read.schema(W.MANIFEST).parquet(f"{folder}/manifest").collect()
        return folder, {r.file: (r.records, r.bytes, r.sha256) for r in rows}

    (folder, first), (_, again) = files(3, 5), files(8, 8)
    assert first == again and sum(r[0] for r in first.values()) == 60_000
    shards = {}
    for name, (records, _, _) in first.items():
        shards[name[:10]] = shards.get(name[:10], 0) + records
    assert len(shards) == 12 and max(shards.values()) < 2 * 60_000 / 12
    got = W.read_archive(spark, folder)
    assert got.where("record_type = 'revisit'").count() == got.where("refers_to is not null").count() > 0


def test_empty_archive(spark, pages):
    folder = scratch_folder(spark, "warc")
    W.write_archive(pages.limit(0), folder)
    assert W.read_archive(spark, folder).count() == 0


def test_files_that_no_manifest_names_are_not_read_and_damage_is_found(spark, pages):
    folder = scratch_folder(spark, "warc")
    W.write_archive(pages, folder, shards=1)
    local = W.open_store(f"{folder}/data")[1]
    name = next(n for n in os.listdir(local) if n.endswith(".warc.gz"))
    data = open(f"{local}/{name}", "rb").read()
    open(f"{local}/part-99999-00000.warc.gz", "wb").write(data)
    assert W.read_archive(spark, folder).count() == len(PAGES)
    os.remove(f"{local}/.{name}.crc") if os.path.exists(f"{local}/.{name}.crc") else None
    open(f"{local}/{name}", "wb").write(data[:-5] + b"xxxxx")
    with pytest.raises(Exception, match="damaged file"):
        W.read_archive(spark, folder).collect()


def test_files_roll_by_compressed_size(tmp_path, monkeypatch):
    monkeypatch.setattr(W, "ROLL_BYTES", 2000)
    rows = [(i, os.urandom(300).hex()) for i in range(20)]
    batch = pa.RecordBatch.from_pydict({
        "shard": [4] * 20, "page_id": [i for i, _ in rows], "decision": [False] * 20, "digest": [hashlib.sha256(h.encode()).hexdigest() for _, h in rows],
        "refers_to": pa.nulls(20, pa.int64()), "url": [None] * 20, "html": [h.encode() for _, h in rows],
    })
    files = next(iter(W._write(str(tmp_path))(iter([batch])))).to_pylist()
    assert len(files) > 3 and sum(f["records"] for f in files) == 20
    assert [f["file"] for f in files] == sorted(os.listdir(tmp_path))
    assert all(2000 <= f["bytes"] < 3500 for f in files[:-1])
    back = [int(fields["X-Page-ID"]) for f in files for fields, _ in W.parse((tmp_path / f["file"]).read_bytes())]
    assert back == list(range(20))
