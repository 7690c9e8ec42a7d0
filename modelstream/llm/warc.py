"""Pages as WARC archives: the same rows give the same files, byte for byte, whichever tasks write them.

1. Rows are cut into shards by their sort key (page_id, hash of url and payload). The cuts come from a sample that the keys'
   own hashes draw, so they depend on the rows alone.
2. A task sorts one shard and writes it as gzip members, a record each. A file is closed when its compressed size reaches
   `FILE_BYTES`. Record ids, digests and headers are made from the rows; the date is a parameter.
3. Tasks write under temporary names, one per attempt, and return manifest rows. Spark's own commit of the manifest decides
   which attempt counts; only then the files it names get their final names. A file without a manifest row is never read.

Payloads that occur more than once are written once, in the response with the largest page_id; the others are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelstream.config import work_folder
from modelstream.llm.common import stored

# Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"
# Compressed bytes at which a file is closed: it ends with the record that reaches them.
FILE_BYTES = 32 << 20
# Bytes of payload and rows that a shard holds about, the sampled keys per shard, and the most keys sampled in all (16 bytes each).
SHARD_BYTES = 64 << 20
SHARD_ROWS = 50_000
KEYS_PER_SHARD = 16
MOST_KEYS = 1_000_000
READ_BYTES = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:modelstream:warc")

MANIFEST = "shard int, roll int, temporary string, name string, n_records bigint, n_bytes bigint, sha256 string"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, "
    "payload_digest string, record_id string, file string"
)


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null html is empty), bytes, digest of every row of `pages`."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})


def with_record_types(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """page_id, url, payload (null in revisits), bytes, refers_to (null in responses), known_digest, tie of the `page_rows`.

    Of equal payloads of `LEAST_REVISIT` bytes or more the row with the largest page_id is the response, and so are rows that
    repeat that id; a row without an id is one only if no id has its payload. `keys` holds bytes, digest and page_id of the rows.
    """
    often = stored(
        keys.filter(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and response is not null")
        .select("digest", "response"),
        "warc-often",
    )
    again = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")) & (F.col("bytes") >= LEAST_REVISIT)
    return rows.join(often, "digest", "left").select(
        "page_id",
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "bytes",
        F.when(again, F.col("response")).alias("refers_to"),
        F.when(again, F.sha1("payload")).alias("known_digest"),
        tie("digest").alias("tie"),
    )


def tie(digest: str) -> Column:
    """What orders rows with one page_id, and draws the sample."""
    return F.xxhash64(F.col("url"), F.col(digest), F.col("page_id"))


def shard_cuts(rows: DataFrame) -> np.ndarray:
    """The keys (page_id, tie) at which shards begin, but for the first: structured, sorted, the same for the same rows.

    A row is in the sample if its hash falls below a share that the counted rows and bytes set; every `KEYS_PER_SHARD`th key
    of the sample is a cut. At most about `MOST_KEYS` keys come to the driver, whatever the size: shards grow beyond that.
    """
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = max(1, -(-n // SHARD_ROWS), -(-size // SHARD_BYTES))
    keys = min(KEYS_PER_SHARD * shards, MOST_KEYS, n)
    kind = np.dtype([("id", np.int64), ("tie", np.int64)])
    if shards == 1 or not n:
        return np.zeros(0, kind)
    share = F.lit(int(keys / n * (1 << 40)))
    sample = rows.filter(F.pmod(F.xxhash64("tie"), F.lit(1 << 40)) < share)
    found = sample.select(F.coalesce("page_id", F.lit(-(2**63))).alias("id"), "tie").distinct().toPandas()
    out = np.zeros(len(found), kind)
    out["id"], out["tie"] = found["id"], found["tie"]
    out.sort(order=["id", "tie"])
    step = max(1, round(len(out) / shards))
    return out[step::step]


def encoded_uri(url: str) -> str:
    """A URL as a header may hold it: white space, control and other than ASCII characters as percent codes."""
    return re.sub(r"[^\x21-\x7E]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}\n{digest}\n{url}')}>"


def sha1_of(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload, size, refers_to, known_digest, date: str = DATE) -> bytes:
    """A record with all headers. `payload` is null in a revisit, whose digest is given."""
    again = payload is None
    digest = known_digest if again else hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if again else http + payload
    headers = [
        ("WARC-Type", "revisit" if again else "response"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Block-Digest", sha1_of(block)),
        ("Page-Payload-Length", str(size)),
    ]
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if url is not None:
        headers.append(("WARC-Target-URI", encoded_uri(url)))
        if encoded_uri(url) != url:
            headers.append(("Page-Target-Base64", base64.b64encode(url.encode("utf-8", "surrogatepass")).decode()))
    if again:
        headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To-Date", date), ("Page-Refers-To", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member, without a time or a name."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that Spark's shared folder names: local, HDFS, S3 or GS."""
    if re.match(r"file:/+", uri):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/+", "", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class _Rolls:
    """The files of one shard, each written under a temporary name of this attempt."""

    def __init__(self, folder: str, limit: int):
        self.system, self.root = file_system(folder)
        self.folder, self.limit = folder, limit
        self.attempt, self.roll, self.out, self.rows = uuid.uuid4().hex, 0, None, []

    def add(self, shard: int, member: bytes) -> None:
        if self.out is None:
            self.shard, self.temporary = shard, f"_temporary/{shard:07d}-{self.roll:05d}-{self.attempt}"
            self.system.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.system.open_output_stream(f"{self.root}/{self.temporary}")
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.digest.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        """End the open file, if there is one."""
        if self.out is None:
            return
        self.out.close()
        name = f"archive/{self.shard:07d}-{self.roll:05d}.warc.gz"
        self.rows.append((self.shard, self.roll, self.temporary, name, self.records, self.size, self.digest.hexdigest()))
        self.out, self.roll = None, self.roll + 1

    def next_shard(self) -> None:
        self.close()
        self.roll = 0


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], [c.split()[0] for c in MANIFEST.split(", ")])


def write_warc(pages: DataFrame, folder: str, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) to `folder`, which all executors share; the manifest is returned.

    The files are folder/archive/SHARD-ROLL.warc.gz, the manifest folder/manifest (Parquet). The same rows give the same files.
    Null ids, urls and html, empty and repeated rows are written; other columns are left out. An empty table gives an empty manifest.
    Rows that are equal in all three columns stay in one shard. `folder` must be new.
    """
    spark = pages.sparkSession
    rows = page_rows(pages)
    keys = stored(rows.select("page_id", "bytes", "digest", tie("digest").alias("tie")), "warc-keys")
    cuts = shard_cuts(keys)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        keys = np.zeros(len(ids), cuts.dtype)
        keys["id"], keys["tie"] = ids.to_numpy(), ties.to_numpy()
        return pd.Series(np.searchsorted(cuts, keys, side="right").astype(np.int32))

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls, last = _Rolls(folder, file_bytes), None
        for batch in source:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                shard, page_id, url, payload, size, refers_to, known = (c[i].as_py() for c in columns)
                if last is not None and shard != last:
                    rolls.next_shard()
                last = shard
                rolls.add(shard, gzip_member(record_bytes(page_id, url, payload, size, refers_to, known, date)))
        rolls.close()
        yield _manifest_batch(rolls.rows)

    placed = (
        with_record_types(rows, keys)
        .withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-(2**63))), "tie"))
        .repartitionById(len(cuts) + 1, F.col("shard"))
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "tie")
        .select("shard", "page_id", "url", "payload", "bytes", "refers_to", "known_digest")
    )
    placed.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/written")
    return commit(spark, folder)


def commit(spark: SparkSession, folder: str) -> DataFrame:
    """Give the files of folder/written their final names and write folder/manifest; may be run again after a failure."""
    written = spark.read.schema(MANIFEST).parquet(f"{folder}/written")

    def rename(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        system.create_dir(f"{root}/archive", recursive=True)
        for batch in source:
            for row in batch.to_pylist():
                temporary, final = f"{root}/{row['temporary']}", f"{root}/{row['name']}"
                there = system.get_file_info([temporary, final])
                if there[0].type == fs.FileType.File:
                    system.move(temporary, final)
                elif there[1].type != fs.FileType.File or there[1].size != row["n_bytes"]:
                    raise FileNotFoundError(f"{row['name']}: neither the temporary nor the final file is there")
            yield batch

    done = written.mapInArrow(rename, MANIFEST)
    done.write.mode("overwrite").parquet(f"{folder}/manifest")
    # What is left under temporary names belongs to attempts that do not count.
    system, root = file_system(folder)
    if system.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
        system.delete_dir(f"{root}/_temporary")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(data: bytes | memoryview) -> Iterator[bytes]:
    """The unpacked gzip members of a file."""
    data = memoryview(data)
    at = 0
    while at < len(data):
        unpacker = zlib.decompressobj(31)
        out = io.BytesIO()
        while not unpacker.eof:
            if at >= len(data):
                raise ValueError("a gzip member is cut off")
            piece = data[at : at + READ_BYTES]
            out.write(unpacker.decompress(piece))
            at += len(piece)
        at -= len(unpacker.unused_data)
        yield out.getvalue()


def parsed_record(record: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload or null, payload_bytes, digest, record id) of a record; its digests must hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != VERSION.decode().strip():
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n" or sha1_of(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of record {fields['WARC-Record-ID']} is damaged")
    url = fields.get("WARC-Target-URI")
    if "Page-Target-Base64" in fields:
        url = base64.b64decode(fields["Page-Target-Base64"]).decode("utf-8", "surrogatepass")
    number = lambda name: int(fields[name]) if name in fields else None
    length = len(payload) if payload is not None else number("Page-Payload-Length")
    return number("Page-ID"), url, fields["WARC-Type"], number("Page-Refers-To"), payload, length, digest, fields["WARC-Record-ID"]


def _records(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    for files in source:
        for i in range(files.num_rows):
            name, held, rows = files.column(0)[i].as_py(), 0, []
            for member in members(files.column(1)[i].as_buffer()):
                rows.append((*parsed_record(member), name))
                held += len(member)
                if held >= READ_BYTES:
                    yield batch(rows)
                    held, rows = 0, []
            if rows:
                yield batch(rows)


def check_archives(spark: SparkSession, folder: str) -> int:
    """The number of files of `folder`; an error if one is missing, too many or of another size than its manifest says."""
    said = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select(F.regexp_extract("name", "[^/]+$", 0).alias("file"), "n_bytes")
    n = said.count()
    if not n:
        return 0
    there = spark.read.format("binaryFile").load(f"{folder}/archive").select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "length")
    wrong = said.join(there, "file", "full").filter(~F.col("n_bytes").eqNullSafe(F.col("length"))).select("file").first()
    if wrong:
        raise ValueError(f"{folder}: {wrong.file} is not as the manifest says")
    return n


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the committed files of `folder`, with checked digests; a revisit has no payload.

    Files are compared with the manifest first. A damaged record is an error. A task holds a file packed and a record unpacked.
    """
    if not check_archives(spark, folder):
        return spark.createDataFrame([], RECORD)
    files = spark.read.format("binaryFile").load(f"{folder}/archive")
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content").mapInArrow(_records, RECORD)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """`pages` written as archives and read back."""
    folder = folder or work_folder(pages.sparkSession, "warc")
    write_warc(pages, folder)
    return read_warc(pages.sparkSession, folder)


ORACLE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
),
largest AS (SELECT payload, max(page_id) AS response FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload)
SELECT p.page_id, p.payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM payloads p LEFT JOIN largest l ON p.payload_bytes >= 1000 AND l.payload = p.payload
"""
