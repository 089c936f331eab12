"""Deterministic, sharded WARC archives, written and read in tasks.

Records are ordered by id and hash of the content, their bytes are summed up in this order, and every
`SHARD_BYTES` a new shard begins, so many rows of one id, or without any, are many shards too; equal
rows are one row with a number until they are written. The driver gets one key per shard. A shard's
records, each a gzip member, go into files that roll before `FILE_BYTES` compressed bytes.
Headers, record ids and digests are made anew from the row alone. Of equal payloads of at least
`revisit_bytes` bytes, rows with the smallest id are responses and all others revisits of them.

A task writes under temporary names of its own and reports its files as rows. Only files of tasks
that succeeded are renamed, by a job over those rows that may be repeated, and the manifest is
written last; readers open what the manifest lists. So a lost executor leaves nothing behind that
is read. Names and contents of the files are the same for each run over one table.

Defined cases: a NULL payload is an empty one; a NULL or empty url leaves the target header out,
and control characters in one are escaped; a NULL id sorts first, its header
is left out, and its row is a response that no revisit refers to; rows
that repeat id and payload are all responses; an empty table gives an archive without files; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlestream.session import written

SHARD_BYTES = 32 << 20
FILE_BYTES = 8 << 20
# Bytes of a record beside its payload, about.
HEAD_BYTES = 600

# Digests of payloads that occur more than once and are sent to all executors; more are joined.
BROADCAST_DIGESTS = 100_000

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.NAMESPACE_URL

MANIFEST = "name string, temporary string, records bigint, bytes bigint, digest string"
RECORD = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _escaped(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {digest} {kind}')}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
    refers_url: str | None, date: str = DATE,
) -> bytes:
    """One WARC/1.1 record: a response with its HTTP head, or a revisit without the payload."""
    digest = base32_sha1(payload)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    kind = "response" if refers_to is None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, digest, kind))]
    if url:
        fields.append(("WARC-Target-URI", _escaped(url)))
    fields += [("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE),
                   ("WARC-Refers-To", _record_id(refers_to, digest, "response")),
                   ("WARC-Refers-To-Date", date)]
        if refers_url:
            fields.append(("WARC-Refers-To-Target-URI", _escaped(refers_url)))
        fields.append(("X-Refers-To-Page", str(refers_to)))
    if page_id is not None:
        fields.append(("X-Page", str(page_id)))
    fields += [("X-Payload-Length", str(len(payload))),
               ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time and name, so that equal records are equal files."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Shard:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, file_bytes: int) -> None:
        self.store, self.folder = _filesystem(folder)
        self.shard, self.file_bytes = shard, file_bytes
        self.done: list[tuple] = []
        self.out = None

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.file_bytes:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"_temporary/{uuid.uuid4().hex}-{self.name}"
            self.out = self.store.open_output_stream(
                f"{self.folder}/{self.temporary}", compression=None
            )
            self.size = self.records = 0
            self.digest = hashlib.sha1()
        self.out.write(member)
        self.size += len(member)
        self.records += 1
        self.digest.update(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.name, self.temporary, self.records, self.size, self.digest.hexdigest()))


def _rows(done: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*done, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _writer(folder: str, file_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, done = None, []
        for batch in batches:
            columns = (batch.column(c) for c in ("shard", "times", "page_id", "url", "payload", "first", "first_url"))
            for at, times, page_id, url, payload, first, first_url in zip(*columns, strict=True):
                if shard is None or shard.shard != at.as_py():
                    if shard is not None:
                        shard.close()
                        done += shard.done
                    shard = _Shard(folder, at.as_py(), file_bytes)
                refers_to = first.as_py()
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to, first_url.as_py(), date)
                member = gzip_member(data)
                for _ in range(times.as_py()):
                    shard.add(member)
        if shard is not None:
            shard.close()
            done += shard.done
        if done:
            yield _rows(done)

    return write


def _keys(pages: DataFrame, folder: str, shard_bytes: int) -> DataFrame:
    """For each id and content: how many rows (`times`) of how many bytes (`size`) there are, and the
    `shard` and `start`, in bytes, of the first in the order of ids and hashes.

    Bytes are summed up in parts by range, then over the parts, of which there are few.
    """
    sums = pages.groupBy("page_id", "hash").agg(F.count("*").alias("times"), F.max("size").alias("size"))
    parts, _ = written(
        sums.withColumn("bytes", F.col("times") * F.col("size")).repartitionByRange("page_id", "hash")
        .withColumn("part", F.spark_partition_id()), f"{folder}/_work/parts",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.sum("bytes").alias("bytes")).select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_start"))
    own = Window.partitionBy("part").orderBy("page_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("bytes").over(own), F.lit(0))
    placed = parts.join(F.broadcast(starts), "part").withColumn("start", start)
    return placed.select(
        "page_id", "hash", "times", "size", "start",
        F.expr(f"start div {int(shard_bytes)}").cast("int").alias("shard"),
    )


def _ordered(page_ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """Byte strings in the order of ids, NULL first, and hashes."""
    out = np.zeros((len(page_ids), 17), np.uint8)
    out[:, 0] = page_ids.is_valid().to_numpy(zero_copy_only=False)
    for at, column in ((1, page_ids.fill_null(0)), (9, hashes)):
        shifted = column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, at:at + 8] = shifted.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


def _cuts(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the shards that a key begins in, and the first such key of each."""
    first = keys.groupBy("shard").agg(F.min(F.struct("page_id", "hash")).alias("first"))
    found = first.select("shard", "first.page_id", "first.hash").toArrow().combine_chunks().sort_by("shard")
    page_ids, hashes = (found.column(c).combine_chunks() for c in ("page_id", "hash"))
    return found.column("shard").to_numpy(), _ordered(page_ids, hashes)


def _sharded(shards: np.ndarray, cuts: np.ndarray):
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _ordered(batch.column("page_id"), batch.column("hash"))
            at = shards[np.searchsorted(cuts, key, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at.astype(np.int32)), pa.array(np.ones(len(at), np.int64))],
                names=[*batch.schema.names, "shard", "times"],
            )

    return shard


def _dealt(repeated: DataFrame, keys: DataFrame, shard_bytes: int) -> DataFrame:
    """Equal rows as one row per shard that they reach into, with how many of them start there."""
    at = keys.filter("times > 1").withColumnRenamed("page_id", "id").withColumnRenamed("shard", "begin")
    once = repeated.groupBy("page_id", "url", "hash", F.sha1("payload").alias("sha")).agg(
        F.first("payload").alias("payload"), F.count("*").alias("copies"))
    spans = once.join(at, (once["hash"] == at["hash"]) & once["page_id"].eqNullSafe(at["id"])).drop(at["hash"])
    last = F.expr(f"(start + (copies - 1) * size) div {int(shard_bytes)}").cast("int")
    spans = spans.withColumn("shard", F.explode(F.sequence("begin", last)))

    def up_to(shard: Column) -> Column:
        rows = F.ceil((shard.cast("bigint") * shard_bytes - F.col("start")) / F.col("size"))
        return F.least(F.greatest(rows, F.lit(0)), F.col("copies"))

    times = up_to(F.col("shard") + 1) - up_to(F.col("shard"))
    return spans.withColumn("times", times).filter("times > 0").select(
        "page_id", "url", "payload", "hash", "shard", "times")


def write(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write one record per row to `folder`, a new path that all executors share, and return the
    manifest: name, records, compressed bytes and SHA-1 of each file."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    source = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"),
        payload.alias("payload"),
    )
    source = source.withColumn("hash", F.xxhash64("page_id", "url", "payload"))
    digests, _ = written(
        source.select("page_id", "url", "hash", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")),
        f"{folder}/_work/digests",
    )
    firsts, many = written(
        digests.filter(F.col("n") >= revisit_bytes).groupBy("digest").agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("copies")
        ).filter("copies > 1").select("digest", "first.page_id", "first.url"),
        f"{folder}/_work/repeated",
    )
    firsts = firsts.toDF("digest", "first", "first_url")
    if many <= BROADCAST_DIGESTS:
        firsts = F.broadcast(firsts)
    sizes = digests.withColumn("size", (F.col("n") + HEAD_BYTES).cast("bigint"))
    keys, _ = written(_keys(sizes, folder, shard_bytes), f"{folder}/_work/keys")
    equal, several = written(keys.filter("times > 1").select("hash").distinct(), f"{folder}/_work/equal")
    if several and several <= BROADCAST_DIGESTS:
        equal = F.broadcast(equal)
    shards, cuts = _cuts(keys)
    dealt = (source.join(equal, "hash", "left_anti") if several else source).select(
        "page_id", "url", "payload", "hash"
    ).mapInArrow(
        _sharded(shards, cuts),
        "page_id bigint, url string, payload binary, hash bigint, shard int, times bigint",
    )
    if several:
        dealt = dealt.unionByName(_dealt(source.join(equal, "hash", "left_semi"), keys, shard_bytes))
    later = F.col("page_id") > F.col("first")
    dealt = dealt.withColumn("digest", F.sha1("payload")).join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "hash", "shard", "times", F.when(later, F.col("first")).alias("first"),
        F.when(later, F.col("first_url")).alias("first_url"),
    )
    total = keys.agg(F.max(F.expr(f"(start + (times - 1) * size) div {int(shard_bytes)}"))).first()[0] or 0
    dealt = dealt.repartitionById(total + 1, "shard").sortWithinPartitions("shard", "page_id", "hash", "url", "payload")

    store, path = _filesystem(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)
    files, _ = written(dealt.mapInArrow(_writer(folder, file_bytes, date), MANIFEST), f"{folder}/_work/files")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = _filesystem(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if own.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    own.move(f"{base}/{temporary}", f"{base}/{name}")
            yield batch

    manifest, _ = written(
        files.mapInArrow(rename, MANIFEST).drop("temporary"), f"{folder}/manifest"
    )
    store.delete_dir(f"{path}/_temporary")
    return manifest


def parse(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, one gzip member at a time."""
    unpack, parts = zlib.decompressobj(31), []
    for data in stream:
        while data:
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
            if unpack.eof:
                yield _parsed(b"".join(parts))
                unpack, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the file ends inside a record")


def _parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(rest[:n])}":
        raise ValueError("a block does not fit its digest")
    return fields, rest[:n]


def _reader(folder: str, with_payload: bool):
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def number(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def rows(name: str) -> Iterator[tuple]:
        store, path = _filesystem(folder)
        with store.open_input_stream(f"{path}/{name}", compression=None) as source:
            for fields, block in parse(iter(lambda: source.read(1 << 20), b"")):
                payload = None
                n, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    n = len(payload)
                    if digest != base32_sha1(payload):
                        raise ValueError(f"{name}: a payload does not fit its digest")
                yield (number(fields, "X-Page"), fields.get("WARC-Target-URI"),
                       payload if with_payload else None, n, digest, fields["WARC-Type"],
                       number(fields, "X-Refers-To-Page"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                held: list[tuple] = []
                for row in rows(name):
                    held.append(row)
                    if len(held) == 500:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    def _batch(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    return read


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files that the manifest of `folder` lists, digests checked."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("name")
    # One task per file: the place of a file among the sorted names, of which there are as many as files.
    names = sorted(r["name"] for r in manifest.collect())
    listed = spark.createDataFrame(list(enumerate(names)), "file int, name string")
    return listed.repartitionById(max(1, len(names)), "file").select("name").mapInArrow(
        _reader(folder, with_payload), RECORD
    )
