"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page_id, payloads of one page_id by their digests, and cut into shards at
running totals of their bytes, so shards are even however the ids lie, and the same table gives the same files, byte for
byte. Only rows with equal page_id and payload are never parted. A shard is written by one task as gzip members, one per record, into files that are rolled when their
compressed size reaches a limit. Headers, record ids and digests are made anew. Every
attempt of a task writes under names of its own; the names go to a manifest table, then the files listed there
are moved to their final names, and only the second manifest, written after the last move,
makes an archive readable. A lost executor leaves files that no manifest names.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes that with the least
page_id is the response, and the others are revisits that hold no payload. Null page_ids come
last. Of rows with equal page_id and payload one is the response. A null html is an empty payload, a null url has no
target header. Other columns are ignored; an empty table gives an archive without files.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadweld.llm.tables import materialize
from quadweld.operators.running import running_totals
from quadweld.operators.stage import scratch_dir

MIN_REVISIT = 100
#: Payload bytes that a shard is made for, and the least and the largest number of shards; of very many bytes, shards are larger.
SHARD_BYTES, MIN_SHARDS, MAX_SHARDS = 64 << 20, 64, 100_000
#: What the headers of a record weigh beside its payload.
HEAD_BYTES = 512
ROLL_BYTES = 32 << 20
DATE = "2020-01-01T00:00:00Z"
READ_BYTES = 1 << 16
READ_TASKS = 10_000

_RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by a URI or an absolute path."""
    return fs.FileSystem.from_uri(folder)


def _urn(*parts: object) -> str:
    """A record id that follows from the content."""
    digest = hashlib.sha256("\0".join(map(str, parts)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16])}>"


def record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _header(value: str | None) -> str | None:
    return None if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def page_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    headers = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": _urn(page_id, digest, is_revisit),
        "WARC-Date": date,
        "WARC-Target-URI": _header(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Page-Id": page_id,
        "X-Payload-Length": len(payload),
    }
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    if is_revisit:
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = _urn(refers_to, digest, False)
        headers["X-Refers-To-Page"] = refers_to
    headers["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(block).hexdigest()}"
    headers["Content-Type"] = "application/http; msgtype=response"
    return record(headers, block)


class Roller:
    """Writes one shard; ``done`` lists its files as (name, temporary name, records, bytes, digest)."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.folder = opened(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.done: list[tuple] = []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"_temporary-{uuid.uuid4().hex}-{self.name}"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
            info = {
                "WARC-Type": "warcinfo",
                "WARC-Record-ID": _urn(self.name),
                "WARC-Date": self.date,
                "WARC-Filename": self.name,
                "Content-Type": "application/warc-fields",
            }
            self._member(record(info, b"format: WARC file version 1.1\r\n"))
        self._member(data)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def _member(self, data: bytes) -> None:
        press = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = press.compress(data) + press.flush()
        self.out.write(member)
        self.bytes += len(member)
        self.digest.update(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.temporary, self.records, self.bytes, self.digest.hexdigest()))
            self.out = None


_FILES = "name string, temporary string, records long, bytes long, sha256 string"


def _files(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in _FILES.split(", ")]
    )


def _writer(folder: str, roll_bytes: int, date: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, noted, last = None, None, None
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns[5] = columns[5].cast(pa.binary())
            for shard, page, digest, is_page, url, html, refers_to in zip(*(c.to_pylist() for c in columns), strict=True):
                if not is_page:
                    noted = (page, digest, refers_to)
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        roller.close()
                        yield _files(roller.done)
                    roller = Roller(folder, shard, roll_bytes, date)
                payload = html or b""
                # A note on this page, or an equal row just before, makes it a revisit.
                revisits = noted is not None and noted[:2] == (page, digest)
                target = noted[2] if revisits else page
                if not revisits and last == (page, digest) and len(payload) >= MIN_REVISIT:
                    revisits = True
                last = (page, digest)
                roller.add(page_record(page, url, payload, digest, target if revisits else None, revisits, date))
        if roller is not None:
            roller.close()
            yield _files(roller.done)

    return run


def _commit(folder: str):
    def run(batches):
        store, top = opened(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                final, temporary = f"{top}/{row['name']}", f"{top}/{row['temporary']}"
                # A retry finds what was moved before.
                if store.get_file_info(temporary).type != fs.FileType.NotFound:
                    store.move(temporary, final)
                if store.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} is not as written")
            yield batch

    return run


def revisits(digests: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages whose payload another page has first."""
    long = digests.where(F.col("size") >= MIN_REVISIT)
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    met = long.join(firsts.where("n > 1 AND refers_to IS NOT NULL"), "digest")
    return met.where("page_id IS NULL OR page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def _place() -> Column:
    """Text whose order is that of records: page_id, null last, then the digest."""
    number = (F.col("page_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string")
    return F.concat(F.coalesce(F.lpad(number, 20, "0"), F.lit("~")), F.substring("digest", 1, 16))


def shard_firsts(digests: DataFrame, shard_bytes: int, min_shards: int) -> list[str]:
    """The least place of each shard, in order: one short text a shard, at most ``MAX_SHARDS``."""
    weighed = digests.select(_place().alias("place"), (F.col("size") + HEAD_BYTES).alias("weight"))
    total = weighed.agg(F.sum("weight")).first()[0] or 0
    shards = min(max(min_shards, -(-total // shard_bytes)), MAX_SHARDS)
    upto = running_totals(weighed, [], ["place"], {"upto": "weight"}, {})
    shard = F.floor((F.col("upto") - F.col("weight")) / max(1, -(-total // shards)))
    return sorted({row["first"] for row in upto.groupBy(shard.alias("shard")).agg(F.min("place").alias("first")).collect()})


def _shard(firsts: list[str]) -> Column:
    """Number of the last shard that starts at or before a record, by bisection."""
    bounds = F.split(F.lit(",".join(firsts)), ",")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(firsts).bit_length()))])
    passed = lambda at, step: F.when(F.get(bounds, at + step - 1) <= F.col("place"), at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), passed) - 1


def write_archive(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    min_shards: int = MIN_SHARDS,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
) -> None:
    """Write ``pages`` (page_id, url, html) as an archive into a new folder of a shared store."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html, 256).alias("digest"), "url", "html")
    digests = materialize(keyed.select("page_id", "digest", F.octet_length(html).cast("long").alias("size")), "digests")
    firsts = shard_firsts(digests, shard_bytes, min_shards) or ["~"]
    columns = ["page_id", "digest", "is_page", "url", "html", "refers_to"]
    rows = keyed.withColumns({"is_page": F.lit(True), "refers_to": F.lit(None).cast("long")}).select(*columns)
    notes = revisits(digests).withColumns(
        {"is_page": F.lit(False), "url": F.lit(None).cast("string"), "html": F.lit(None).cast("string")}
    )
    # Payloads go through one exchange, together with the notes on them.
    dealt = (
        rows.unionByName(notes.select(*columns))
        .withColumn("place", _place())
        .select(_shard(firsts).alias("shard"), *columns)
        .repartitionById(len(firsts), F.col("shard"))
        .sortWithinPartitions("shard", "page_id", "digest", "is_page", "url")
    )
    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
    dealt.mapInArrow(_writer(folder, roll_bytes, date), _FILES).write.parquet(f"{folder}/_written")
    written = pages.sparkSession.read.schema(_FILES).parquet(f"{folder}/_written")
    written.mapInArrow(_commit(folder), _FILES).write.parquet(f"{folder}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream; memory holds one member and a piece of the next."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(READ_BYTES)):
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last record is cut short")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    n = int(headers["Content-Length"])
    if not version.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:n]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _reader(folder: str):
    def run(batches):
        store, top = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{top}/{row['name']}", compression=None) as stream:
                    for member in _members(stream):
                        headers, block = parse_record(member)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else None
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["WARC-Block-Digest"]:
                            raise ValueError(f"block digest differs in {row['name']}")
                        if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest differs in {row['name']}")
                        rows.append(
                            (
                                _number(headers.get("X-Page-Id")),
                                _plain(headers.get("WARC-Target-URI")),
                                headers["WARC-Type"],
                                int(headers["X-Payload-Length"]) if payload is None else len(payload),
                                digest,
                                _number(headers.get("X-Refers-To-Page")),
                                payload,
                            )
                        )
                        held += len(block)
                        if held >= 8 << 20:
                            yield _records(rows)
                            rows, held = [], 0
                if rows:
                    yield _records(rows)

    return run


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    columns = zip(zip(*rows, strict=True), types, strict=True)
    names = [f.split()[0] for f in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All page records of a committed archive, digests verified."""
    manifest = spark.read.schema(_FILES).parquet(f"{folder}/_manifest")
    # Names are short, what they stand for is long: a given number of tasks keeps them apart.
    files = max(1, min(manifest.count(), READ_TASKS))
    return manifest.select("name").repartition(files, "name").mapInArrow(_reader(folder), _RECORDS)


def op1_warc(pages: DataFrame) -> DataFrame:
    """Pages as they come back from an archive written into the shared folder."""
    spark = pages.sparkSession
    folder = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, folder if "://" in folder else f"file://{folder}")
    read = read_archive(spark, folder if "://" in folder else f"file://{folder}")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH paid AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM paid
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
