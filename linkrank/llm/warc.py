"""WARC archives: sharded deterministic writer with manifests, and a reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.common import task, Work

#: Payload bytes of a shard, as long as there are at most MAX_SHARDS; a larger corpus gets larger shards, not more of them.
SHARD_BYTES = 16 << 20
MAX_SHARDS = 8192
#: Compressed bytes after which the writer goes on with the next file.
FILE_BYTES = 128 << 20
SAMPLES_A_SHARD = 64
MANIFEST = "shard int, part int, file string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
#: Stands for a null id among numbers.
BELOW_ALL = -(2**63)
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record(kind: str, record_id: str, date: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response with its payload, or a revisit without; both have the full payload's length and digest in their headers."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{i}:{digest.hex()}')}>"
    uri = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32(digest)}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}")]
    if url is None:
        fields.append(("X-No-URL", "1"))
    elif url != uri:
        fields.append(("X-URL", base64.b64encode(url.encode()).decode()))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", name(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    return _record("revisit" if revisit else "response", name(page_id), date, fields, block)


class _Roller:
    """Writes the records of one shard to files under temporary names, and gives each its own name when it is complete."""

    def __init__(self, folder: str, shard: int, file_bytes: int, date: str, level: int):
        self.files, self.root = FileSystem.from_uri(folder)
        self.shard, self.limit, self.date, self.level, self.part, self.out = shard, file_bytes, date, level, 0, None

    def open(self) -> None:
        self.name = f"part-{self.shard:05d}-{self.part:05d}.warc.gz"
        self.temporary = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out, self.hash, self.size, self.records, self.first = self.files.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0, None
        record_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, self.name)}>"
        self.put(_record("warcinfo", record_id, self.date, [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def put(self, record: bytes) -> None:
        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # a gzip member for each record, without a time
        data = z.compress(record) + z.flush()
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def add(self, page_id: int | None, record: bytes) -> dict | None:
        if self.out is None:
            self.open()
        self.put(record)
        self.records += 1
        self.first = page_id if self.records == 1 else self.first
        self.last = page_id
        return self.close() if self.size >= self.limit else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        final = f"{self.root}/{self.name}"
        if self._held(final):  # by an attempt whose executor was lost: a file that a manifest may name is never away, not even for a moment
            self.files.delete_file(self.temporary)
        else:
            self.files.move(self.temporary, final)
        self.part += 1
        return {"shard": self.shard, "part": self.part - 1, "file": self.name, "records": self.records, "bytes": self.size, "sha256": self.hash.hexdigest(), "first_id": self.first, "last_id": self.last}


    def _held(self, path: str) -> bool:
        """Whether the file is there already. Files get their names complete, and a task writes the same bytes again; others are an error."""
        info = self.files.get_file_info(path)
        if info.type == FileType.NotFound:
            return False
        found = hashlib.sha256()
        with self.files.open_input_stream(path, compression=None) as stream:
            while data := stream.read(1 << 20):
                found.update(data)
        if found.hexdigest() != self.hash.hexdigest():
            raise ValueError(f"{path} is there with other bytes; the archive's folder must be new")
        return True


MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int, date: str, level: int) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, id and digest; a row that names the response of its payload precedes the pages it holds for."""
    roller, done, mark = None, [], None
    for batch in batches:
        for shard, page_id, digest, top, url, html in zip(*(batch.column(k) for k in range(6)), strict=True):
            shard, page_id, digest, top = shard.as_py(), page_id.as_py(), digest.as_py(), top.as_py()
            if roller is None or roller.shard != shard:
                done += [roller.close()] if roller else []
                roller = _Roller(folder, shard, file_bytes, date, level)
            if top is not None:
                mark = (page_id, digest, top)
                continue
            same = mark is not None and mark[:2] == (page_id, digest)
            done.append(roller.add(page_id, page_record(page_id, url.as_py(), html.as_py().encode(), digest, mark[2] if same else None, same, date)))
        if done := [x for x in done if x]:
            yield pa.RecordBatch.from_pylist(done, schema=MANIFEST_ARROW)
            done = []
    if roller and (last := roller.close()):
        yield pa.RecordBatch.from_pylist([*done, last], schema=MANIFEST_ARROW)


def write_archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> str:
    """Writes ``pages (page_id, url, html)`` and returns the folder of the archive; other columns are not looked at.

    Of pages with equal payloads of at least ``least_bytes``, the one with the largest id is a response and the others are
    revisits of it; pages that repeat that id are responses too, and smaller payloads are always responses. A null html is an
    empty payload. Null ids are below all others. An empty table gives an archive with an empty manifest.

    Pages are cut into ranges of ids, and within a null or repeated id of digests, at quantiles of a sample chosen by a hash of both, the same
    in every run, sorted within their range, and written by one task each, which starts a new file once one has ``file_bytes``. Files get
    their names when complete; the manifest, a Parquet table written last, says which files count. A task that
    runs again writes the same bytes to the same names. ``folder`` must be new, in a place that executors reach.
    """
    spark = pages.sparkSession
    work = Work(spark, "warc")
    folder = folder or f"{work.path}/archive"
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.unhex(F.sha1(payload.cast("binary"))).alias("digest"), F.col("url").cast("string"), payload.alias("html"))
    ids = work.store(rows.select("page_id", "digest", F.octet_length("html").cast("long").alias("bytes")), "ids")
    groups = ids.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = work.store(groups, "groups")
    marks = ids.join(groups, "digest").where("page_id < top or page_id is null").where("top is not null").select("page_id", "digest", "top").distinct()
    total = ids.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    shards = int(min(MAX_SHARDS, max(1, -(-(total["bytes"] or 0) // shard_bytes))))
    every = max(1, total["n"] // (shards * SAMPLES_A_SHARD))
    sample = ids.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0).groupBy("page_id", "digest").agg(F.sum("bytes").alias("bytes")).orderBy("page_id", "digest").collect()
    sums = np.cumsum([x["bytes"] for x in sample] or [0])
    at = np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards)
    cuts = sorted({(BELOW_ALL if sample[k]["page_id"] is None else sample[k]["page_id"], bytes(sample[k]["digest"])) for k in at if k < len(sample)})
    cut_ids = np.array([i for i, _ in cuts], np.int64)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        number = ids.fillna(BELOW_ALL).astype("int64").to_numpy()
        shard = np.searchsorted(cut_ids, number, side="left")
        for k in np.flatnonzero(np.isin(number, cut_ids)):  # ids within which there is a cut
            shard[k] = bisect_left(cuts, (int(number[k]), digests.iloc[k]))
        return pd.Series(shard.astype(np.int32))

    every_row = marks.select("page_id", "digest", "top", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    every_row = every_row.unionByName(rows.withColumn("top", F.lit(None).cast("long")))
    every_row = every_row.select(shard_of("page_id", "digest").alias("shard"), "page_id", "digest", "top", "url", "html")
    order = ["shard", "page_id", "digest", F.col("top").desc_nulls_last(), "url"]
    files, root = FileSystem.from_uri(folder)
    files.create_dir(f"{root}/_temporary", recursive=True)
    writer = task(_write, folder=folder, file_bytes=file_bytes, date=date, level=level)
    every_row.repartition(len(cuts) + 1, "shard").sortWithinPartitions(*order).mapInArrow(writer, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def records_of(stream, size: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file with a gzip member for each record."""
    data = stream.read(size)
    while data:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            parts.append(z.decompress(data))
            data = z.unused_data if z.eof else stream.read(size)
            if not z.eof and not data:
                raise ValueError("the archive ends within a record")
        data = data or stream.read(size)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"wrong length of {fields.get('WARC-Record-ID')}")
        yield fields, block


def _read(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    files, root = FileSystem.from_uri(folder)
    for batch in batches:
        for name in batch.column("file").to_pylist():
            rows, held = [], 0
            with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for fields, block in records_of(stream):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} in {name} differs from its headers")
                    number = {k: int(fields[f]) if f in fields else None for k, f in (("page_id", "X-Page-ID"), ("refers_to", "X-Refers-To-Page-ID"))}
                    url = None if "X-No-URL" in fields else base64.b64decode(fields["X-URL"]).decode() if "X-URL" in fields else fields["WARC-Target-URI"]
                    rows.append({**number, "url": url, "record_type": fields["WARC-Type"], "payload_bytes": length, "payload_digest": digest, "payload": payload if payloads else None})
                    held += len(payload) * payloads + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the files that the manifest names; each payload is held against its length and digest while reading."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(parts, "file").mapInArrow(task(_read, folder=folder, payloads=payloads), RECORDS)
