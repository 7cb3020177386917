"""WARC archives with a two-level capture index.

Pages become WARC/1.1 records, one gzip member each. Of records with equal
payloads of at least ``min_bytes`` bytes the one with the smallest id is a
``response``, the others are ``revisit`` records that name it and carry no
payload. Tasks write archive files of their own to a shared folder; only files
named by the committed record table count, so a lost or repeated task leaves
garbage, never a wrong record.

The index has two levels. Captures are sorted by their reversed-host URL key
and id into blocks of ``block_lines`` lines, compressed one by one; every index
file ends with its sparse directory (first key, offset and length of each
block). A lookup goes from the files' key ranges to a file, binary-searches its
directory, reads and unpacks one block, binary-searches that, and then reads
the record's byte range. Lookups are sorted first, so a task reads a block
once, and record ranges that lie together are read together.

Null or empty payloads are archived as empty. Null URLs have an empty key. Rows
that repeat id and payload become one response and revisits of it. Null ids
come last when the smallest id is sought.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievekit.llm.common import stored
from sievekit.session import work_dir

FILE_BYTES = 256 << 20          # an archive file is closed beyond this size
BLOCK_LINES = 1000
READ_BYTES = 8 << 20            # record ranges are read together up to this size
TASK_BYTES = 128 << 20          # of archives or index blocks that a task reads back
GZIP_LEVEL = 4


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.b.org:80/p?q`` becomes ``org,b)/p?q``.
    Scheme, user, default port, fragment and a leading ``www.`` are dropped."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.strip().lower()
    if host.startswith("www."):
        host = host[4:]
    key = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        key += f":{port}"
    return f"{key}){parts.path.lower() or '/'}" + (f"?{parts.query}" if parts.query else "")


def _filesystem(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


def _uri(folder: str) -> str:
    """``file:/x`` as Hadoop writes it, in the form Arrow reads."""
    return "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder


def record(uid: str, url: str | None, payload: bytes, digest: str, kind: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit has no block; ``X-Payload-Length`` keeps the
    length of the full payload."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:capture:{uid}>",
            f"WARC-Target-URI: {(url or '').replace(chr(13), '').replace(chr(10), '')}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    body = payload
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:capture:{refers_to}>"]
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) != n + 4:
        raise ValueError("record is cut short")
    return fields, rest[:n]


def with_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``id``, ``url``, ``payload``, ``refers_to`` (null for responses). Only
    ids and digests are grouped and joined by digest; payloads are shuffled
    once, by id and digest, which no hot payload skews."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    # one key for join and window, null ids included, so payloads are dealt once
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn(
        "key", F.concat_ws(" ", F.hex("digest"), F.col("id").cast("string")))
    slim = rows.where(F.octet_length("payload") >= min_bytes).select("id", "digest", "key")
    shared = stored(slim.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"), "shared-payloads")
    flags = slim.join(shared, "digest").select("key", "first", F.lit(True).alias("shared")).distinct()
    joined = rows.join(flags, "key", "left")
    copy = F.row_number().over(Window.partitionBy("key").orderBy("url"))
    again = F.coalesce("shared", F.lit(False)) & ~(F.col("id").eqNullSafe(F.col("first")) & (copy == 1))
    return (joined.withColumn("again", again)
                  .select("id", "url", "payload", F.when(F.col("again"), F.col("first")).alias("refers_to"), "again"))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives and returns their record table: ``key``, ``id``,
    ``file``, ``at``, ``size``."""
    where = _uri(folder)
    rows = with_types(pages, id_col, url_col, payload_col, min_bytes)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        fs, path = _filesystem(where)
        out, name, at = None, None, 0
        for batch in batches:
            made = []
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to", "again")]
            for uid, url, payload, refers_to, again in zip(*columns):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    # a name of its own for every attempt
                    name, at = f"capture-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                data = gzip.compress(record(str(uid), url, payload, digest, "revisit" if again else "response",
                                            str(refers_to)), GZIP_LEVEL, mtime=0)
                out.write(data)
                made.append((url_key(url), name, at, len(data)))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array([m[i] for m in made], k) for i, k in
                                       enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))]],
                ["id", "key", "file", "at", "size"])
        if out is not None:
            out.close()

    fs, path = _filesystem(where)
    fs.create_dir(path, recursive=True)
    return stored(rows.mapInArrow(run, f"id {id_type}, key string, file string, at long, size long"), "records")


def _sort_text(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.lit(""))


def write_index(spark: SparkSession, records: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts the captures into index files. Returns one row per file:
    ``file``, ``first``, ``last`` (keys with ids), ``directory`` (its place)."""
    where = _uri(folder)
    lines = (records.select("key", _sort_text(F.col("id")).alias("id"), "file", "at", "size")
                    .repartitionByRange("key", "id", "file", "at").sortWithinPartitions("key", "id", "file", "at"))

    def run(batches):
        fs, path = _filesystem(where)
        out, name, directory, block, first, last = None, None, [], [], None, None

        def flush():
            data = zlib.compress("\n".join(json.dumps(x) for x in block).encode())
            directory.append((block[0][:2], out.tell(), len(data)))
            out.write(data)
            block.clear()

        for batch in batches:
            for entry in zip(*[batch.column(c).to_pylist() for c in ("key", "id", "file", "at", "size")]):
                if out is None:
                    name = f"index-{uuid.uuid4().hex}.cdx"
                    out, first = fs.open_output_stream(f"{path}/{name}", compression=None), entry[:2]
                block.append(entry)
                last = entry[:2]
                if len(block) >= block_lines:
                    flush()
        if out is None:
            return
        if block:
            flush()
        tail = zlib.compress(json.dumps(directory).encode())
        at = out.tell()
        out.write(tail)
        out.close()
        cols = [name, *first, *last]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([c], pa.string()) for c in cols], pa.array([at], pa.int64()), pa.array([len(tail)], pa.int64())],
            ["file", "first_key", "first_id", "last_key", "last_id", "at", "size"])

    fs, path = _filesystem(where)
    fs.create_dir(path, recursive=True)
    schema = "file string, first_key string, first_id string, last_key string, last_id string, at long, size long"
    return stored(lines.mapInArrow(run, schema), "index-files")


def _tasks(df: DataFrame, size: int) -> int:
    """Tasks for reading ``size`` bytes of files: the rows that name them are too slim to tell."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def lookup(captures: DataFrame, index_files: DataFrame, folder: str) -> DataFrame:
    """Places (``file``, ``at``, ``size``) of the captures asked for by ``url``
    and ``id``; a capture asked for n times is found once, one archived n times
    n times."""
    where = _uri(folder)
    # one row per index file, hence as many as the index was written by tasks
    files = sorted(((r.first_key, r.first_id), (r.last_key, r.last_id), r.file, r.at, r.size)
                   for r in index_files.collect())
    asked = (captures.select("url", _sort_text(F.col("id")).alias("id")).distinct())

    def keyed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string()), batch.column("id")],
                ["key", "id"])

    tasks = _tasks(captures, sum(f[3] for f in files))
    asked = (asked.mapInArrow(keyed, "key string, id string").distinct()
                  .repartitionByRange(tasks, "key", "id").sortWithinPartitions("key", "id"))

    def run(batches):
        fs, path = _filesystem(where)
        lasts = [f[1] for f in files]
        now, handle, directory, block_no, block = None, None, [], None, []
        for batch in batches:
            found = []
            for want in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist()):
                n = bisect.bisect_left(lasts, want)          # first file that can hold it
                while n < len(files) and files[n][0] <= want:
                    if now != n:
                        if handle is not None:
                            handle.close()
                        now, handle, block_no = n, fs.open_input_file(f"{path}/{files[n][2]}"), None
                        tail = handle.read_at(files[n][4], files[n][3])
                        directory = [(tuple(k), at, size) for k, at, size in json.loads(zlib.decompress(tail))]
                    # equal captures may begin in the block before the first whose key is not smaller
                    b = max(0, bisect.bisect_left(directory, want, key=lambda d: d[0]) - 1)
                    while b < len(directory) and directory[b][0] <= want:
                        if block_no != b:
                            raw = zlib.decompress(handle.read_at(directory[b][2], directory[b][1]))
                            block_no, block = b, [json.loads(x) for x in raw.split(b"\n")]
                        i = bisect.bisect_left(block, want, key=lambda e: (e[0], e[1]))
                        while i < len(block) and (block[i][0], block[i][1]) == want:
                            found.append(block[i][2:])
                            i += 1
                        b += 1
                    n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.int64())], ["file", "at", "size"])
        if handle is not None:
            handle.close()

    return asked.mapInArrow(run, "file string, at long, size long")


FIELDS = ("uid string, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to string, payload binary")


def fetch(places: DataFrame, folder: str, payloads: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """Reads the records at the places: ids as text, headers, and the payload
    (null for revisits, or if not asked for). Payload digests are checked."""
    where = _uri(folder)
    places = stored(places, "places")
    tasks = _tasks(places, places.agg(F.sum("size")).first()[0] or 0)
    ordered = places.repartitionByRange(tasks, "file", "at").sortWithinPartitions("file", "at")

    def run(batches):
        fs, path = _filesystem(where)
        now, handle = None, None

        def read(group):
            nonlocal now, handle
            if group[0][0] != now:
                if handle is not None:
                    handle.close()
                now, handle = group[0][0], fs.open_input_file(f"{path}/{group[0][0]}")
            begin = group[0][1]
            data = handle.read_at(group[-1][1] + group[-1][2] - begin, begin)
            for _, at, size in group:
                fields, body = parse(gzip.decompress(data[at - begin:at - begin + size]))
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                    raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
                name = lambda k: fields[k].removeprefix("<urn:capture:").removesuffix(">") if k in fields else None
                yield (name("warc-record-id"), fields["warc-target-uri"], kind, int(fields["x-payload-length"]),
                       digest, name("warc-refers-to"), body if payloads and kind == "response" else None)

        def pack(rows):
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                              [c.split()[0] for c in FIELDS.split(", ")])

        group = []
        for batch in batches:
            for place in zip(*[batch.column(c).to_pylist() for c in ("file", "at", "size")]):
                near = group and place[0] == group[0][0] and place[1] + place[2] - group[0][1] <= read_bytes
                if group and not near:
                    yield pack(list(read(group)))
                    group = []
                group.append(place)
        if group:
            yield pack(list(read(group)))
        if handle is not None:
            handle.close()

    return ordered.mapInArrow(run, FIELDS)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       payload_col: str = "html", min_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Writes archives and index to the shared work folder and reads every
    page's records back through the index."""
    spark = pages.sparkSession
    folder = work_dir(spark, "captures")
    records = write_archive(pages, folder, id_col, url_col, payload_col, min_bytes)
    files = write_index(spark, records, folder)
    asked = pages.select(F.col(url_col).alias("url"), F.col(id_col).alias("id"))
    return fetch(lookup(asked, files, folder), folder, payloads)
