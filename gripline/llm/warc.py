"""Deterministic sharded WARC writer and reader."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import cuts, id_of, range_of, shared_folder, width
from gripline.llm.files import committed, reader

#: Equal payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: A file is closed once it holds so many compressed bytes.
ROLL_BYTES = 256 << 20
#: Date of every record: the table has none, and a clock would make two runs differ.
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the file format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file string, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def labelled(digest: bytes) -> str:
    return "sha1:" + b32encode(digest).decode()


def record(page: int | None, url: str | None, payload: bytes, owner: int | None, revisit: bool) -> bytes:
    """One record as a gzip member, headers and digests made anew."""
    sha1 = hashlib.sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe="%:/?#[]@!$&'()*+,;=~"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": labelled(sha1.digest()),
        "WARC-Block-Digest": labelled(hashlib.sha1(block).digest()),
        "X-Page-ID": "" if page is None else str(page),
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(owner), "X-Refers-To-Page-ID": str(owner)}
    head["Content-Length"] = str(len(block))
    text = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip header without time or name
    return packer.compress(text) + packer.flush()


def _write(folder: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (shard, key, missing); each shard makes files of its own."""

        def rows() -> Iterator[tuple]:
            mark, owner = None, None
            for batch in batches:
                for shard, key, missing, digest, page, url, payload, to in zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "missing", "digest", "page", "url", "payload", "owner")), strict=True):
                    if payload is None:  # says that the pages of this key and digest revisit another
                        mark, owner = (key, missing, digest), to
                    else:
                        revisit = (key, missing, digest) == mark
                        yield shard, page, url, payload, owner if revisit else None, revisit

        done, pending, number, last = [], next(it := rows(), None), 0, None
        while pending is not None:
            shard = pending[0]
            number = number + 1 if shard == last else 0
            last, name = shard, f"pages-{shard:06d}-{number:05d}.warc.gz"
            count, size, sha1 = 0, 0, hashlib.sha1()
            with committed(folder, name) as out:
                while pending is not None and pending[0] == shard and size < roll:
                    member = record(*pending[1:])
                    out.write(member)
                    sha1.update(member)
                    count, size, pending = count + 1, size + len(member), next(it, None)
            done.append((shard, name, count, size, sha1.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["shard", "file", "records", "bytes", "sha1"])

    return run


def owners(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Columns digest and owner: the page that keeps each payload of at least so many bytes which several rows have."""
    big = pages.where(F.octet_length("payload") >= least)
    return big.groupBy("digest").agg(F.max("page").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")


def write(pages: DataFrame, folder: str, shards: int | None = None, roll: int = ROLL_BYTES, least: int = REVISIT_BYTES) -> DataFrame:
    """Write page_id, url and html of every row to WARC files in `folder`; returns the manifest, which names the files that count.

    Records are dealt into ranges of page_id and sorted by (page_id, digest, url); each range fills files that close at
    `roll` compressed bytes. Files get their names only when whole, and the manifest is written last, so a reader never
    sees half of a run. The same rows give the same bytes.

    Of equal payloads of `least` bytes or more, the record with the largest page_id is a response and the others revisit it;
    rows that repeat that page_id are responses too. A null html is an empty payload, a null url an empty one; rows without page_id
    come last and own a payload only if no other row has it. An empty table gives an empty manifest. Other columns are
    not written.
    """
    spark = pages.sparkSession
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    base = pages.select(pages["page_id"].cast("long").alias("page"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    key = id_of(base, "page")
    missing = base["page"].isNull().alias("missing")
    bounds = cuts(pages, id_of(pages, "page_id"), shards or width(spark))
    # Who revisits whom is found on ids and digests alone. It meets the payloads in their range, as a row that comes just before them.
    narrow = base.where(F.octet_length("payload") >= least).select("page", key.alias("key"), missing, "digest").join(owners(base, least), "digest")
    marks = narrow.where(~F.col("page").eqNullSafe(F.col("owner")) & F.col("owner").isNotNull()).select("key", "missing", "digest", "owner").distinct()
    whole = base.select(key.alias("key"), missing, "digest", "page", "url", "payload", F.lit(None).cast("long").alias("owner"))
    both = whole.unionByName(marks, allowMissingColumns=True)
    dealt = both.withColumn("shard", range_of(F.col("key"), bounds)).repartitionById(len(bounds) + 1, "shard")
    dealt = dealt.sortWithinPartitions("shard", "key", "missing", "digest", F.col("payload").isNotNull(), "url")
    manifest = dealt.mapInArrow(_write(folder, roll), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    left, packer, got = b"", zlib.decompressobj(31), []
    while True:
        data = left or stream.read(piece)
        left = b""
        if not data:
            return
        got.append(packer.decompress(data))
        if packer.eof:
            yield b"".join(got)
            left, packer, got = packer.unused_data, zlib.decompressobj(31), []


def parse(text: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a record and its payload; wrong digests raise."""
    head, _, rest = text.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if labelled(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block.partition(b"\r\n\r\n")[2]


def hexed(digest: str) -> str:
    return b32decode(digest.removeprefix("sha1:")).hex()


def _read(folder: str, with_payload: bool, at_once: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with reader(folder, name) as stream:
                    for member in members(stream):
                        f, payload = parse(member)
                        kind = f["WARC-Type"]
                        if kind == "response":  # both are taken from what the archive holds
                            length, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        else:
                            length, digest = int(f["X-Payload-Length"]), hexed(f["WARC-Payload-Digest"])
                        page, to = f["X-Page-ID"], f.get("X-Refers-To-Page-ID")
                        rows.append((int(page) if page else None, f["WARC-Target-URI"], kind, length, digest, int(to) if to else None, payload if with_payload else None))
                        size += len(payload) if with_payload else 200
                        if size > at_once:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def read(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the files that the manifest names, a task for each few files; a revisit has a null-length payload of its own."""
    spread = manifest.select("file").repartition(width(manifest.sparkSession), "file")
    return spread.mapInArrow(_read(folder, with_payload), RECORDS)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to a new shared folder and read them back, without payloads."""
    folder = shared_folder(pages.sparkSession)
    return read(write(pages, folder, **options), folder, with_payload=False).drop("payload", "url")


__all__ = ["parse", "read", "record", "round_trip", "write"]
