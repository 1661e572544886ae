"""Deterministic sharded WARC archives (operator 9).

Records are ordered by page id and cut into shards of similar size, each the work of one task; a shard is written to
files that roll at a compressed size, a sixteenth of the shard's. Headers, record ids and digests are made anew from
the page, so the same pages give the same bytes, whatever attempt writes them. A file is written under a temporary name
and renamed when it is whole; only files named by the manifest, itself a table that Spark commits, belong to the
archive. A lost executor's files are written again.

Among equal payloads of at least ``LEAST_REVISIT`` bytes the smallest page id is the response, the others revisit it.

Defined results: a null page has an empty payload; null addresses are stored as ``about:blank``; rows with a null page
id are responses and are never referred to; repeated rows with the smallest id of their payload are all responses; an
empty table gives an archive without files and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from operator import methodcaller
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.llm.tables import _arrow_schema, written
from kilnwatch.session import shared_folder

LEAST_REVISIT = 100
#: Payload bytes of a shard, unless that gave too many shards.
SHARD_BYTES = 16 << 20
MOST_SHARDS = 1 << 15
#: A file rolls at this part of a shard's payload, in compressed bytes: pages shrink to a quarter, so to some four files.
ROLLS = 16
LEVEL = 5
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard bigint, name string, records bigint, bytes bigint, sha256 string"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def with_payloads(pages: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id", "url", text.alias("html"), F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.octet_length(text).alias("size"),
    )


def revisits(payloads: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages that repeat another's payload; no page text is moved."""
    keys = payloads.where((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).select(
        "page_id", "digest"
    )
    shared = (
        keys.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("refers_to < last")
        .drop("last")
    )
    return keys.join(shared, "digest").where("page_id > refers_to").distinct()


def shard_of(payloads: DataFrame) -> tuple[Column, int, int]:
    """The shard of a page, the number of shards, and the bytes of one.

    Running sums of the bytes in the order of the ids begin a shard at each multiple of its bytes, however the ids are
    spread; the pages of one id stay together. Shards have ``SHARD_BYTES``, or more where there would be over
    ``MOST_SHARDS``, which bounds their starts. Pages without an id are spread over shards of their own by
    their content. Nothing is estimated, so shards do not vary between runs.
    """
    spark = payloads.sparkSession
    size = F.sum(F.col("size") + 512).alias("size")
    known = payloads.where("page_id IS NOT NULL").groupBy("page_id").agg(size)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = known.repartitionByRange(parts, "page_id").sortWithinPartitions("page_id")
    sizes = written(ranged.withColumn("range", F.spark_partition_id()), "page-sizes")
    before, total = {}, 0
    for number, _, held in sorted(sizes.groupBy("range").agg(F.min("page_id"), F.sum("size")).collect()):
        before[number], total = total, total + held
    loose = payloads.where("page_id IS NULL").agg(size).first()[0] or 0
    wide = max(SHARD_BYTES, -(-(total + loose) // MOST_SHARDS))
    offsets = [before.get(number, 0) for number in range(max(before, default=0) + 1)]
    begins = F.element_at(F.array(*map(F.lit, offsets)), F.col("range") + 1)
    within = F.sum("size").over(Window.partitionBy("range").orderBy("page_id")) - F.col("size")
    reached = F.floor((begins + within) / F.lit(wide)).alias("reached")
    firsts = sizes.select("page_id", reached).groupBy("reached").agg(F.min("page_id").alias("first"))
    starts = sorted(r["first"] for r in firsts.collect())
    spread = -(-loose // wide)
    of_null = F.lit(len(starts)) + F.pmod(F.xxhash64("digest"), F.lit(max(1, spread)))
    if not starts:
        return of_null.cast("bigint"), max(1, spread), wide
    # The last start that an id reaches, first among every so many starts and then between two of these.
    step = math.isqrt(len(starts)) + 1
    every, coarse = (_numbers(part) for part in (starts, starts[::step]))

    def reach(limits: Column) -> Column:
        return F.size(F.filter(limits, lambda start: start <= F.col("page_id")))

    skipped = F.greatest(reach(coarse) - 1, F.lit(0)) * step
    place = skipped + reach(F.slice(every, skipped + 1, F.lit(step))) - 1
    shard = F.when(F.col("page_id").isNull(), of_null).otherwise(place)
    return shard.cast("bigint"), len(starts) + spread, wide


def _numbers(values: list[int]) -> Column:
    """The numbers as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def record_id(page_id: object, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{kind}')}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields)]
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of a response or revisit record."""
    kind = "response" if refers_to is None else "revisit"
    target = quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~")
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    )
    fields: list[tuple[str, object]] = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, digest, kind)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if refers_to is None:
        return _record(fields, head + payload)
    fields += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", record_id(refers_to, digest, "response")),
        ("X-Refers-To-Page-Id", refers_to),
        ("WARC-Truncated", "length"),
    ]
    return _record(fields, head)


def _member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path on it; Arrow reaches local, HDFS and object stores."""
    if "://" not in folder:
        return pafs.FileSystem.from_uri(folder.removeprefix("file:"))
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class _Roller:
    """Writes the files of one shard, each under a temporary name until it is whole."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.roll_bytes = roll_bytes
        self.store, self.top = _open(folder)
        self.shard, self.number, self.out = shard, 0, None

    def add(self, record: bytes) -> dict | None:
        """Write a record; the manifest row of a file that this one would overfill is returned."""
        member = _member(record)
        done = None
        if self.out is not None and self.size + len(member) > self.roll_bytes:
            done = self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.top}/_temporary-{uuid.uuid4().hex}-{self.name}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.records = self.size = 0
            self.digest = hashlib.sha256()
            info = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", record_id(self.shard, self.name, "warcinfo")),
                ("WARC-Date", DATE),
                ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"),
            ]
            self._put(_member(_record(info, b"format: WARC File Format 1.1\r\n")))
        self._put(member)
        self.records += 1
        return done

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        final = f"{self.top}/{self.name}"
        try:
            self.store.move(self.temporary, final)
        except OSError:
            # Another attempt at this shard has published the same bytes.
            if self.store.get_file_info(final).size != self.size:
                raise
            self.store.delete_file(self.temporary)
        row = {
            "shard": self.shard, "name": self.name, "records": self.records, "bytes": self.size,
            "sha256": self.digest.hexdigest(),
        }
        self.out, self.number = None, self.number + 1
        return row


def write_archives(pages: DataFrame, folder: str, roll_bytes: int | None = None) -> DataFrame:
    """Write the pages below ``folder``, which all executors share; returns the committed manifest.

    ``roll_bytes`` is the compressed size of a file; by default it follows the size of the shards.
    """
    spark = pages.sparkSession
    payloads = with_payloads(pages)
    shard, shards, wide = shard_of(payloads)
    roll_bytes = roll_bytes or wide // ROLLS
    # A row without text stands before the page that it marks as a revisit: the texts are moved once, by shard.
    marks = revisits(payloads)
    columns = {"url": "string", "html": "string", "refers_to": "bigint"}
    missing = {name: F.lit(None).cast(kind).alias(name) for name, kind in columns.items()}
    both = payloads.select(shard.alias("shard"), "page_id", "digest", "url", "html", missing["refers_to"]).unionByName(
        marks.select(shard.alias("shard"), "page_id", "digest", missing["url"], missing["html"], "refers_to")
    )
    # By range, as a hash would give some tasks several shards and others none.
    ordered = both.repartitionByRange(shards, "shard").sortWithinPartitions(
        "shard", "page_id", "digest", F.col("refers_to").desc_nulls_last(), "url"
    )
    store, top = _open(folder)
    store.create_dir(top, recursive=True)
    schema = _arrow_schema(spark, MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, mark = None, (None, None, None)
        for batch in batches:
            done = []
            # One row at a time: pages are large, and their texts are copied once more as Python objects.
            for shard, page_id, digest, url, page, refers_to in zip(
                *(map(methodcaller("as_py"), batch.column(i)) for i in range(6)), strict=True
            ):
                if refers_to is not None:
                    mark = (page_id, digest, refers_to)
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        done.append(roller.close())
                    roller = _Roller(folder, shard, roll_bytes)
                first = mark[2] if mark[:2] == (page_id, digest) else None
                full = roller.add(page_record(page_id, url, page.encode(), digest, first))
                if full:
                    done.append(full)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if roller is not None:
            yield pa.RecordBatch.from_pylist([roller.close()], schema=schema)

    return written(ordered.mapInArrow(write, MANIFEST), "warc-manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    packed = b""
    while True:
        opener, parts = zlib.decompressobj(31), []
        while not opener.eof:
            packed = packed or stream.read(READ_BYTES)
            if not packed:
                if parts:
                    raise ValueError("archive ends within a record")
                return
            parts.append(opener.decompress(packed))
            packed = opener.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record; its digest is compared."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    return fields, block


def page_row(fields: dict[str, str], block: bytes) -> dict | None:
    """What a record says of its page; None for a record of the file itself."""
    kind = fields["WARC-Type"]
    if kind == "warcinfo":
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers is None else int(refers),
    }


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per page record of the files that the manifest names; sizes and digests are checked."""
    schema = _arrow_schema(manifest.sparkSession, RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _open(folder)
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if store.get_file_info(f"{top}/{name}").size != size:
                    raise ValueError(f"{name} is not the file that the manifest names")
                rows = []
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = page_row(*parse_record(data))
                        if row:
                            rows.append(row)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = max(1, manifest.count())
    return manifest.select("name", "bytes").repartition(min(files, 1 << 16), "name").mapInArrow(read, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages into a fresh archive and read it back."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
