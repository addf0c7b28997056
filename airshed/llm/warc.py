"""Deterministic sharded WARC writer and reader.

1. Payload digests decide what a record is: of equal payloads of at least
   MIN_REVISIT bytes the one with the largest page id is the response, the
   others are revisits of it. Only digests and ids move for that.
2. Shards: the records in page-id order, cut by their exact running size, so
   the files do not depend on how the input or the shuffle is partitioned.
3. Records are made and compressed where the pages are read (each is a gzip
   member of its own), so only compressed bytes are joined and sorted. A task
   sorts a shard's records by id and appends them; a file is closed once it
   has ``roll_bytes`` compressed bytes. Record ids, lengths and digests are
   made anew from the payload; nothing depends on the clock or the machine, so
   a rerun writes the same bytes.
4. Every file is first written under a name of its own task attempt. The
   manifest (a Parquet table, committed by Spark, one row per file) names the
   attempts that count; a second job renames those, and may be repeated. Files
   of lost attempts stay in ``_attempts`` and are removed at the end.

Defined cases: null html is an empty payload, null url gives no target URI; a
null page id is written as such and is never the response of others with an
id; repeated rows are written once each, and rows that share the response's id
are all responses; an empty table gives an empty archive; only the named
columns are read. Files are written with pyarrow's file systems (local, HDFS,
S3, GCS), in the shared folder by default.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import column, materialize, release, running_total, small_batches, table
from airshed.session import scratch_path

MIN_REVISIT = 1000
SHARD_BYTES = 16 << 20
ROLL_BYTES = 4 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
MAX_TASKS = 50_000
#: Fixed value: the profile of a revisit by equal payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = {
    "shard": pa.int64(), "part": pa.int64(), "name": pa.string(), "attempt": pa.string(), "records": pa.int64(),
    "bytes": pa.int64(), "sha256": pa.string(), "first_id": pa.int64(), "last_id": pa.int64(),
}
_MANIFEST_DDL = "shard long, part long, name string, attempt string, records long, bytes long, sha256 string, first_id long, last_id long"
_ROW = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
_ROW_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    name = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return None if name == "null" else int(name)


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Date", DATE), *fields, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, is_revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head of the page, no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [("WARC-Record-ID", _urn(page_id))]
    if url:
        fields.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~")))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to)), ("Content-Type", "application/http; msgtype=response")]
        return _record("revisit", fields, http)
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return _record("response", fields, http + payload)


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # gzip without a time stamp
    return z.compress(record) + z.flush()


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, fields.values(), strict=True)], names=list(fields))


class _File:
    """An archive file being written under the name of its attempt."""

    def __init__(self, fs: pafs.FileSystem, root: str, shard: int, part: int):
        self.shard, self.part = shard, part
        self.name = f"{shard:08d}-{part:05d}.warc.gz"
        self.attempt = f"_attempts/{self.name}.{uuid.uuid4().hex}"
        self.stream = fs.open_output_stream(f"{root}/{self.attempt}", compression=None)
        self.sha, self.size, self.records, self.first, self.last = hashlib.sha256(), 0, 0, None, None
        info = f"format: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        self._write(_member(_record("warcinfo", [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info)))

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, page_id: int | None, member: bytes) -> None:
        self._write(member)
        self.first = page_id if self.records == 0 else self.first
        self.last = page_id
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return self.shard, self.part, self.name, self.attempt, self.records, self.size, self.sha.hexdigest(), self.first, self.last


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page as a compressed response record."""
    for b in batches:
        digests, members = [], []
        for page_id, url, html in zip(*(column(b, c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            payload = (html or "").encode()
            digests.append(hashlib.sha1(payload).hexdigest())
            members.append(_member(page_record(page_id, url, payload, digests[-1], len(payload), False, None)))
        cols = [column(b, "page_id"), column(b, "url"), pa.array(digests, pa.string()), pa.array(members, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "digest", "member"])


def _writer(dest: str, roll_bytes: int):
    names = ("shard", "page_id", "url", "member", "digest", "n_bytes", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(dest)
        file = None
        for b in batches:
            for shard, page_id, url, member, digest, n_bytes, refers_to in zip(*(column(b, c).to_pylist() for c in names), strict=True):
                if file is not None and (file.shard != shard or file.size >= roll_bytes):
                    part = file.part + 1 if file.shard == shard else 0
                    yield _batch([file.close()], _MANIFEST)
                    file = _File(fs, root, shard, part)
                file = file or _File(fs, root, shard, 0)
                file.add(page_id, member or _member(page_record(page_id, url, b"", digest, n_bytes, True, refers_to)))
        if file is not None:
            yield _batch([file.close()], _MANIFEST)

    return run


def _committer(dest: str):
    """Rename the attempts that the manifest names; repeating it is harmless."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(dest)
        for b in batches:
            done = []
            for name, attempt, size in zip(*(column(b, c).to_pylist() for c in ("name", "attempt", "bytes")), strict=True):
                source, target = fs.get_file_info([f"{root}/{attempt}", f"{root}/{name}"])
                if source.type == pafs.FileType.File:
                    fs.move(f"{root}/{attempt}", f"{root}/{name}")
                    target = fs.get_file_info(f"{root}/{name}")
                if target.type != pafs.FileType.File or target.size != size:
                    raise OSError(f"{name}: {target.size} bytes, the manifest has {size}")
                done.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["name"])

    return run


def plan_records(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """page_id, digest, n_bytes, shard, is_revisit, refers_to: one row per
    different (page_id, payload); no payload moves."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    heads = pages.select(F.col("page_id").cast("long"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    heads = materialize(heads.groupBy("page_id", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("times")), "warc-heads")
    placed = running_total(heads.withColumn("_size", F.col("times") * (F.col("n_bytes") + 1024)), ["page_id", "digest"], "_size", "_at")
    kept = heads.where(F.col("n_bytes") >= MIN_REVISIT).groupBy("digest", "n_bytes").agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_c"))
    kept = materialize(kept.where("_c > 1 AND _kept IS NOT NULL").select("digest", "n_bytes", "_kept"), "warc-kept")
    revisit = F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    return placed.join(kept, ["digest", "n_bytes"], "left").select(
        "page_id", "digest", "n_bytes", F.floor(F.col("_at") / shard_bytes).cast("long").alias("shard"),
        revisit.alias("is_revisit"), F.when(revisit, F.col("_kept")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, dest: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``dest``; returns the manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    plan = materialize(plan_records(pages, shard_bytes), "warc-plan")
    shards = (plan.agg(F.max("shard")).first()[0] or 0) + 1
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    made = plain.mapInArrow(_responses, "page_id long, url string, digest string, member binary")
    right = plan.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "n_bytes", "shard", "is_revisit", "refers_to")
    rows = made.join(right, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("digest") == F.col("_d")))
    member = F.when(~F.col("is_revisit"), F.col("member"))
    rows = rows.select("shard", "page_id", "url", member.alias("member"), "digest", "n_bytes", "refers_to")
    tasks = min(shards, MAX_TASKS)
    by_shard = rows.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "page_id", "digest", "url")
    fs, root = pafs.FileSystem.from_uri(dest)
    fs.create_dir(f"{root}/_attempts", recursive=True)
    by_shard.mapInArrow(_writer(dest, roll_bytes), _MANIFEST_DDL).write.parquet(f"{dest}/_manifest")
    manifest = spark.read.parquet(f"{dest}/_manifest")
    manifest.mapInArrow(_committer(dest), "name string").write.parquet(f"{dest}/_committed")
    fs.delete_dir(f"{root}/_attempts")
    release(plan)
    return manifest


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; checks lengths and block digests."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines)
        block = data[end + 4 : end + 4 + int(head["Content-Length"])]
        at = end + 4 + len(block) + 4
        if version != "WARC/1.1" or data[at - 4 : at] != b"\r\n\r\n" or _sha1(block) != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
        yield head, block


def _members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, out = zlib.decompressobj(31), []
    for data in chunks:
        while data:
            out.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(out)
                z, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the last gzip member is cut off")


def _page_row(head: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.decode().split("Content-Length: ")[1].split("\r\n")[0])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if head["WARC-Type"] == "response" and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
    refers = head.get("WARC-Refers-To")
    return _page_id(head["WARC-Record-ID"]), stated, digest, head["WARC-Type"], refers and _page_id(refers)


def _reader(dest: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(dest)
        for b in batches:
            for name, records, sha in zip(*(column(b, c).to_pylist() for c in ("name", "records", "sha256")), strict=True):
                digest, rows, n = hashlib.sha256(), [], 0

                def chunks(name=name, digest=digest):
                    with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                        while data := f.read(1 << 20):
                            digest.update(data)
                            yield data

                for member in _members(chunks()):
                    for head, block in parse_records(member):
                        if head["WARC-Type"] != "warcinfo":
                            rows.append(_page_row(head, block))
                            n += 1
                    if len(rows) >= 4096:
                        yield _batch(rows, _ROW)
                        rows = []
                if n != records or digest.hexdigest() != sha:
                    raise ValueError(f"{name} doesn't match the manifest")
                yield _batch(rows, _ROW)

    return run


def read_archives(spark: SparkSession, dest: str) -> DataFrame:
    """The page records of a committed archive, one task per few files."""
    manifest = spark.read.parquet(f"{dest}/_manifest")
    spread = manifest.repartition(max(1, min(manifest.count(), MAX_TASKS)), "name")
    return spread.mapInArrow(_reader(dest), _ROW_DDL)


def q_warc(spark, sf_dir: str) -> DataFrame:
    """op5: write all pages as WARC, read the archives back."""
    dest = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), dest)
    return read_archives(spark, dest)


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM d
"""
