"""WARC archives: a deterministic sharded writer with manifests, and its reader.

Writing goes through these steps, each of which survives lost executors:

1. Digests and sizes of all payloads are computed and written (no payload is shuffled for that). Payloads of
   at least ``REVISIT_BYTES`` that occur more than once get one response, that of the largest page id; the
   others become revisits of it.
2. Running sums of the sizes in page order give the shards: ranges of page ids of about equal bytes.
   They depend on the data only, never on sampled range bounds.
3. Records are sorted by page id in their shard and written as gzip members; a file is closed once its compressed
   size reaches ``roll_bytes``. Tasks write under temporary names of their own.
4. The files of the attempts that counted make a manifest; then they are renamed, and the final manifest is written
   last. Renaming again does nothing, and files that no manifest names are never read. What other attempts left is removed then.

Each shard is written by a task of its own, and files are renamed and read back in as many tasks as there are files.

NULL payloads are empty; NULL page ids come first and are left out of the record; a NULL URL becomes a page
name. Of repeated rows (equal id and payload of at least ``REVISIT_BYTES``) the first is the response and the
others revisit it. Empty tables make an archive without files. Only the id, URL and payload columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartflow.llm.common import materialize, table
from cartflow.settings import scratch_path
from cartflow.sources.versioned import delete_path

REVISIT_BYTES = 1000
#: Payload bytes of a shard, at least; with more than MAX_SHARDS of them shards get larger instead.
SHARD_BYTES = 32 << 20
MAX_SHARDS = 20_000
#: The compressed bytes after which the next record starts a new file are this share of a shard's payload, so that files grow
#: with their shards: 4 MB for the smallest, some 600 MB for those of an archive of 100 TB.
ROLL_SHARE = 8
LEVEL = 5
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "name string, temporary string, shard int, number int, records bigint, bytes bigint, sha1 string"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "payload binary"
)


# --- one record ---


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    """A name that depends only on the record."""
    name = hashlib.sha1(f"{page_id}|{digest}|{copy}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=name, version=5)}>"


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    head = "\r\n".join(lines).encode("utf-8", "replace")
    return zlib.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", level, wbits=31)


def page_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, copy: int, level: int
) -> bytes:
    """A response with the payload, or a revisit with its HTTP header only; all headers are made anew."""
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(c if " " < c else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", _digest(block)),
        ("WARC-Payload-Digest", digest),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if url is None:
        headers.append(("X-No-URL", "true"))
    if revisit:
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", record_id(refers_to, digest, 0)))
        if refers_to is not None:
            headers.append(("X-Refers-To-Page", str(refers_to)))
    return _member(headers, block, level)


def file_header(name: str, level: int) -> bytes:
    headers = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(None, name, 0)),
        ("WARC-Date", DATE),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _member(headers, b"format: WARC File Format 1.1\r\n", level)


def members(read, size: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one at a time."""
    data = read(size)
    while data:
        unzip, parts = zlib.decompressobj(wbits=31), []
        while not unzip.eof:
            if not data:
                raise ValueError("archive ends inside a record")
            parts.append(unzip.decompress(data))
            data = unzip.unused_data if unzip.eof else read(size)
        yield b"".join(parts)
        data = data or read(size)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if "WARC-Block-Digest" in headers and _digest(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"block of {headers['WARC-Record-ID']} does not match its digest")
    return headers, block


def read_page(headers: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORDS`` for a response or revisit."""
    revisit = headers["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    digest = headers["WARC-Payload-Digest"]
    if not revisit and _digest(payload) != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    number = headers.get("X-Page-ID")
    target = headers.get("X-Refers-To-Page")
    return (
        None if number is None else int(number),
        None if "X-No-URL" in headers else headers["WARC-Target-URI"],
        int(headers["X-Payload-Length"]) if revisit else len(payload),
        base64.b32decode(digest.removeprefix("sha1:")).hex(),
        headers["WARC-Type"],
        None if target is None else int(target),
        payload,
    )


# --- files in the shared folder ---


def _file_system(path: str):
    """The file system of a URI and the path in it; tasks write archives there as raw files."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _writer(root: str, roll_bytes: int, level: int):
    def write(batches):
        import pyarrow as pa

        store, folder = _file_system(root)
        temporary = posixpath.join(folder, "_temporary", uuid.uuid4().hex)
        store.create_dir(temporary, recursive=True)
        out, done = None, None
        shard, number = None, 0
        owner, last, copy = None, None, 0

        def closed() -> pa.RecordBatch:
            out.close()
            row = [done["name"], done["path"], shard, number, done["records"], done["bytes"], done["sha1"].hexdigest()]
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            names = [c.split()[0] for c in FILES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        def append(data: bytes, records: int) -> None:
            out.write(data)
            done["sha1"].update(data)
            done["bytes"] += len(data)
            done["records"] += records

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                key = (row["page_id"], row["key"])
                if row["payload"] is None:  # a role: what follows with this id and payload is a revisit
                    owner = (key, row["refers_to"])
                    continue
                copy = copy + 1 if key == last else 0
                last = key
                payload = row["payload"]
                role = owner is not None and owner[0] == key
                revisit = role or (copy > 0 and len(payload) >= REVISIT_BYTES)
                refers_to = owner[1] if role else row["page_id"] if revisit else None
                data = page_record(row["page_id"], row["url"], payload, refers_to, revisit, copy, level)
                if out is not None and (row["shard"] != shard or done["bytes"] + len(data) > roll_bytes):
                    number_next = number + 1 if row["shard"] == shard else 0
                    yield closed()
                    out, number = None, number_next
                if out is None:
                    number = number if row["shard"] == shard else 0
                    shard = row["shard"]
                    name = f"shard-{shard:06d}-{number:05d}.warc.gz"
                    path = posixpath.join(temporary, name)
                    out = store.open_output_stream(path, compression=None)
                    done = {"name": name, "path": path, "records": 0, "bytes": 0, "sha1": hashlib.sha1()}
                    append(file_header(name, level), 0)
                append(data, 1)
        if out is not None:
            yield closed()

    return write


def _rename(root: str):
    """Gives files their final names; a file that is there already was renamed by an earlier attempt."""

    def rename(batches):
        from pyarrow import fs

        store, folder = _file_system(root)
        for batch in batches:
            for name, temporary in zip(
                batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True
            ):
                final = posixpath.join(folder, name)
                if store.get_file_info(final).type == fs.FileType.NotFound:
                    store.move(temporary, final)
            yield batch

    return rename


def _reader(root: str, payloads: bool):
    def read(batches):
        import pyarrow as pa

        store, folder = _file_system(root)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for name, expected in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist(), strict=True):
                found, size, count = [], 0, 0
                with store.open_input_stream(posixpath.join(folder, name), compression=None) as stream:
                    for data in members(stream.read):
                        headers, block = parse_record(data)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        row = read_page(headers, block)
                        found.append(row if payloads else (*row[:-1], None))
                        size += len(block) if payloads else 100
                        count += 1
                        if size > 8 << 20 or len(found) >= 10_000:
                            yield rows(found)
                            found, size = [], 0
                if found:
                    yield rows(found)
                if count != expected:
                    raise ValueError(f"{name} has {count} records, its manifest says {expected}")

    return read


# --- the writer ---


def _spread(files: DataFrame) -> DataFrame:
    """A few files a task at most; given a number of tasks, Spark doesn't take small lists together."""
    return files.repartition(min(max(1, files.count()), MAX_SHARDS))


def _shard_size(sizes: DataFrame, shard_bytes: int) -> int:
    """Payload bytes of a shard, so that there are at most about MAX_SHARDS of them."""
    total = sizes.agg(F.sum("payload_bytes")).first()[0] or 0
    return max(shard_bytes, total // MAX_SHARDS)


def _shard_starts(spark: SparkSession, sizes: DataFrame, step: int) -> list[int]:
    """The first page id of every shard; as many values as shards, so at most about MAX_SHARDS."""
    sums = sizes.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.sum("payload_bytes").alias("size"))
    ranged = materialize(
        spark, sums.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "warc-sizes"
    )
    # One row for each range, so a single window is bounded by the number of partitions.
    totals = ranged.groupBy("part").agg(F.sum("size").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.sum("size").over(Window.partitionBy("part").orderBy("page_id")) - F.col("size")
    placed = ranged.withColumn("own", own).join(totals, "part")
    shard = F.floor((F.col("before") + F.col("own")) / F.lit(step))
    return sorted(r[0] for r in placed.groupBy(shard.alias("shard")).agg(F.min("page_id")).select("min(page_id)").collect())


def _shard_of(page_id: Column, starts: list[int]) -> Column:
    @F.arrow_udf("int")
    def of_batch(ids):
        import numpy as np
        import pyarrow as pa

        known = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        return pa.array(np.maximum(np.searchsorted(np.array(starts, np.int64), known, side="right") - 1, 0), pa.int32())

    return of_batch(page_id)


def write_archive(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int | None = None,
    level: int = LEVEL,
) -> DataFrame:
    """Writes an archive below ``root`` (a new folder all executors reach) and returns its manifest.

    Files are closed beyond ``roll_bytes`` compressed bytes, by default a ROLL_SHARE of the payload bytes of a shard.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.unhex(F.sha2(payload, 256)).alias("key"),
        F.lit(None).cast("bigint").alias("refers_to"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    )
    sizes = materialize(
        spark, records.select("page_id", "key", F.octet_length("payload").cast("bigint").alias("payload_bytes")), "warc-keys"
    )
    step = _shard_size(sizes, shard_bytes)
    starts = _shard_starts(spark, sizes, step)
    roll_bytes = max(1, step // ROLL_SHARE) if roll_bytes is None else roll_bytes
    owners = (
        sizes.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("key")
        .agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    roles = (
        sizes.join(owners, "key")
        .filter(~F.col("page_id").eqNullSafe(F.col("owner")))
        .select("page_id", "key", F.col("owner").alias("refers_to"))
        .distinct()
        .select("*", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    )
    placed = records.unionByName(roles).withColumn("shard", _shard_of(F.col("page_id"), starts))
    parts = (
        placed.repartitionById(max(1, len(starts)), "shard")
        .sortWithinPartitions("shard", "page_id", "key", F.col("payload").isNotNull())
        .mapInArrow(_writer(root, roll_bytes, level), FILES)
    )
    files = materialize(spark, parts, "warc-files")
    final = _spread(files).mapInArrow(_rename(root), FILES).drop("temporary")
    final.write.parquet(f"{root}/manifest")
    delete_path(spark, f"{root}/_temporary")
    return spark.read.schema(final.schema).parquet(f"{root}/manifest")


def read_archive(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """The page records of an archive, all digests checked; ``payload`` is NULL for revisits and without ``payloads``."""
    files = spark.read.schema(FILES).parquet(f"{root}/manifest")
    return _spread(files.select("name", "records")).mapInArrow(_reader(root, payloads), RECORDS)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    root = scratch_path(spark, "warc")
    write_archive(spark, table(spark, sf_dir, "pages"), root)
    return read_archive(spark, root, payloads=False).drop("payload", "url")


def oracle_sql() -> str:
    return f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
judged AS (
  SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS owner,
         row_number() OVER (PARTITION BY h, page_id) AS copy
  FROM page)
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN strlen(h) >= {REVISIT_BYTES} AND (page_id IS DISTINCT FROM owner OR copy > 1) THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN strlen(h) >= {REVISIT_BYTES} AND (page_id IS DISTINCT FROM owner OR copy > 1) THEN owner END AS refers_to
FROM judged
"""
