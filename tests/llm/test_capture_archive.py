import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from sievekit.llm import capture_archive as C
from sievekit.session import work_dir

SCHEMA = "page_id long, url string, html string, key string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", "f") for i, u, h in rows], SCHEMA)


def want(rows, min_bytes=0):
    out, done = [], set()
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    for i, u, h in rows:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = least.get(h or "")
        again = len(data) >= min_bytes and (i != first or (i, h or "") in done)
        done.add((i, h or ""))
        out.append((str(i), len(data), digest, "revisit" if again else "response", str(first) if again else None))
    return sorted(out, key=str)


ROWS = [(3, "http://www.b.org/x", "<p>é same</p>"), (1, "https://b.org/x#f", "<p>é same</p>"), (2, None, None),
        (4, "not a url", ""), (5, "http://a.b.org:8080/Q?z=1", "x" * 300_000), (6, "http://[bad", "<p>é same</p>"),
        (7, "http://b.org/x", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (8, "http://b.org/\r\nx", "y"),
        (9, "http://c.org", "once"), (9, "http://c.org", "once"), (10, "http://c.org", "once")]


def test_round_trip(spark):
    for min_bytes in (0, 5):
        got = C.archive_round_trip(pages(spark, ROWS), min_bytes=min_bytes, payloads=True).collect()
        assert sorted(((r.uid, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                      key=str) == want(ROWS, min_bytes)
        text = {i: h or "" for i, _, h in ROWS}
        assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
        assert all(bytes(r.payload).decode() == text[int(r.uid)] for r in got if r.record_type == "response")


def test_empty_table(spark):
    assert C.archive_round_trip(pages(spark, [])).count() == 0


def test_lookup_through_many_small_blocks(spark):
    rows = [(i, f"http://h{i % 7}.org/p{i // 3}", f"body {i % 40}") for i in range(500)]
    df = pages(spark, rows)
    folder = work_dir(spark, "t")
    records = C.write_archive(df, folder, file_bytes=5000)
    files = C.write_index(spark, records, folder, block_lines=3)
    asked = spark.createDataFrame([(u, i) for i, u, _ in rows if i % 5 == 0] + [("http://h1.org/none", 3), (rows[9][1], 9)] * 2,
                                  "url string, id long")
    got = C.fetch(C.lookup(asked, files, folder), folder).collect()
    assert sorted(int(r.uid) for r in got) == sorted({i for i, _, _ in rows if i % 5 == 0} | {9})
    assert records.select("file").distinct().count() > 1


def test_record_and_keys():
    data = C.record("1", "http://x.org", b"abc", "D", "response", None)
    fields, body = C.parse(gzip.decompress(gzip.compress(data)))
    assert body == b"abc" and fields["content-length"] == "3" and fields["warc-type"] == "response"
    assert C.url_key("http://www.Example.com:80/A/b?q=1#f") == "com,example)/a/b?q=1"
    assert C.url_key("https://m.example.com:8443") == "com,example,m:8443)/"
    assert C.url_key(None) == ""


def test_read_back_is_dealt_by_bytes(spark, monkeypatch):
    """As many tasks as units of bytes, however slim the rows that name them are."""
    rows = [(i, f"http://s{i}.org/", "".join(hashlib.sha256(f"{i}/{j}".encode()).hexdigest() for j in range(40))) for i in range(120)]
    monkeypatch.setattr(C, "TASK_BYTES", 10_000)
    folder = work_dir(spark, "captures")
    table = pages(spark, rows)
    files = C.write_index(spark, C.write_archive(table, folder, "page_id", "url", "html", 0), folder)
    got = C.fetch(C.lookup(table.select("url", F.col("page_id").alias("id")), files, folder), folder)
    assert got.rdd.getNumPartitions() > 8
    assert sorted(int(r.uid) for r in got.collect()) == list(range(120))
    assert sum(n > 0 for n in got.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()) > 8
