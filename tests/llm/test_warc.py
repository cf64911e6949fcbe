import glob
import gzip
import hashlib
import os
import random
import tempfile
import time

import duckdb

from colmask.llm import warc as w
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, duck, same_as_sql

PAGES = "page_id bigint, url string, html string"


def test_query_against_sql(spark):
    assert same_as_sql(w.op5_warc(spark, SF_DIR), w.OP5_SQL, duck())


def test_long_urls_against_sql(spark):
    """Urls of 100 KB and more, spaces tripled, as a single page, a response and its revisit."""
    sf = tempfile.mkdtemp(prefix="warc-")
    body = "y" * 2000
    data = [
        (1, "data:," + "a" * 100_000, "one"), (2, "http://x/?" + " " * 100_000, body), (3, "u", body),
        (4, "http://x/?" + "b" * 3_000_000, body), (5, "u", "last"),
    ]
    spark.createDataFrame(data, PAGES).coalesce(1).write.parquet(f"{sf}/pages.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet/*.parquet'")
    assert same_as_sql(w.op5_warc(spark, sf), w.OP5_SQL, connection)


def odd_pages(spark):
    big, other = "x" * 1500 + "é", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50
    data = [
        (1, "u", big), (5, "u", big), (3, None, big), (None, "u", big), (5, "u", big), (6, "u\r\nX: y", "small"), (7, "u", "small"),
        (8, "u", None), (9, "u", ""), (10, "u", other), (11, "u", other + "\r\n\r\n"), (12, "u", "\r\n\r\n"),
        (None, "u", "n" * 2000), (None, "u", "n" * 2000), (-4, "u", "y" * 300_000),
    ]
    return spark.createDataFrame([(*d, "z", "z") for d in data], PAGES + ", digest string, kept string"), data


def written(spark, pages, **options):
    path = tempfile.mkdtemp(prefix="warc-") + "/out"
    w.write_warc(pages, path, **options)
    return path


def test_odd_rows(spark):
    pages, data = odd_pages(spark)
    path = written(spark, pages)
    got = rows(w.archived_pages(w.read_warc(spark, path)))
    want = []
    for page, _, html in data:
        raw = (html or "").encode()
        ids = [p for p, _, h in data if h == html and p is not None]
        kept = max(ids) if ids and len(raw) >= 1000 and sum(h == html for _, _, h in data) > 1 else None
        again = kept is not None and kept != page
        want.append(
            (page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", kept if again else None)
        )
    assert got == sorted(want, key=repr)
    records = w.read_warc(spark, path)
    assert records.filter("gap is not null").count() == 0
    urls = {r["target_uri"] for r in records.collect()}
    assert urls == {"u", "", "u%20%20X:%20y"}
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in records.collect())
    empty = written(spark, pages.limit(0))
    assert w.read_warc(spark, empty).count() == 0


def files(path):
    return sorted(glob.glob(f"{path}/**/part-*", recursive=True))


def test_files_have_a_bounded_size(spark):
    """Also where many large pages follow on small ones."""
    long = "CASE WHEN id >= 900 THEN 60000 ELSE 20 END"
    pages = spark.range(1000).selectExpr("id AS page_id", "'u' AS url", f"repeat(string(id), {long}) AS html").coalesce(1)
    path = written(spark, pages, file_bytes=400_000)
    sizes = [os.path.getsize(f) for f in files(path)]
    assert 50 < len(sizes) < 400 and max(sizes) <= 400_000
    assert w.archived_pages(w.read_warc(spark, path)).count() == 1000


def plain_record(number, payload, digest=None):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    sha = digest or hashlib.sha1(http).hexdigest()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{number}>\r\nWARC-Block-Digest: sha1:{sha}\r\n"
    head += f"Content-Type: application/http\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def found(data):
    out = []
    for x in w.salvage(data):
        out.append(("gap", x.offset, x.length) if isinstance(x, w.Gap) else x.headers["warc-record-id"][10:-1])
    return out


def test_salvage_of_plain_records():
    parts = [plain_record(i, b"p%d WARC/1.0\r\n" % i * 20) for i in range(5)]
    assert found(b"".join(parts)) == ["0", "1", "2", "3", "4"]
    # A changed byte, a lost stretch over two records, junk in front, a cut end.
    broken = bytearray(b"".join(parts))
    broken[len(parts[0]) + 300] ^= 1
    assert found(bytes(broken)) == ["0", ("gap", len(parts[0]), len(parts[1])), "2", "3", "4"]
    lost = parts[0] + parts[1][:200] + parts[2][100:] + parts[3]
    gap = 200 + len(parts[2]) - 100
    assert found(lost) == ["0", ("gap", len(parts[0]), gap), "3"]
    assert found(b"junk WARC/1.0\r\n" + parts[0] + parts[1][:-1]) == [("gap", 0, 15), "0", ("gap", 15 + len(parts[0]), len(parts[1]) - 1)]
    assert found(b"") == [] and found(b"nothing") == [("gap", 0, 7)]


def test_salvage_with_long_headers():
    def long(number, size):
        return plain_record(number, b"p").replace(b"WARC-Type", b"X-Long: " + b"a" * size + b"\r\nWARC-Type")

    parts = [long(0, 70_000), plain_record(1, b"x"), long(2, 200_000), plain_record(3, b"x")]
    assert found(b"".join(parts)) == ["0", "1", "2", "3"]
    assert found(gzip.compress(parts[2]) + parts[0]) == ["2", "0"]
    # A header that lost its end, in front of the next record.
    cut = parts[2][:150_000]
    assert found(parts[0] + cut + b"\r\n" + parts[1]) == ["0", ("gap", len(parts[0]), len(cut) + 2), "1"]
    # Very many version lines that begin no record, with an end of a header far behind or none.
    start = time.monotonic()
    for junk in (b"WARC/1.1\r\n" * 200_000, b"a: WARC/1.1\r\n" * 200_000):
        assert found(junk) == [("gap", 0, len(junk))]
        assert found(junk + b"no name\r\n" + parts[1]) == [("gap", 0, len(junk) + 9), "1"]
    assert time.monotonic() - start < 60


def test_salvage_of_gzip_members():
    members = [gzip.compress(plain_record(i, os.urandom(500))) for i in range(4)]
    assert found(b"".join(members)) == ["0", "1", "2", "3"]
    broken = bytearray(b"".join(members))
    broken[len(members[0]) + 150] ^= 0xFF
    assert found(bytes(broken)) == ["0", ("gap", len(members[0]), len(members[1])), "2", "3"]
    mixed = members[0] + plain_record(9, b"x") + members[1][:-20] + members[2]
    start = len(members[0]) + len(plain_record(9, b"x"))
    assert found(mixed) == ["0", "9", ("gap", start, len(members[1]) - 20), "2"]
    # A sound member whose record fails its digest is a gap too.
    bad = gzip.compress(plain_record(5, b"x", "0" * 40))
    assert found(bad + members[3]) == [("gap", 0, len(bad)), "3"]


def test_gaps_are_logged_with_their_places(spark):
    path = written(spark, spark.range(30).selectExpr("id AS page_id", "'u' AS url", "repeat(string(id), 99) AS html").coalesce(1))
    (name,) = files(path)
    folder, _, name = name.rpartition("/")
    os.remove(f"{folder}/.{name}.crc")
    with open(f"{folder}/{name}", "r+b") as file:
        data = bytearray(file.read())
        second = data.index(b"WARC/1.1", 10)
        third = data.index(b"WARC/1.1", second + 10)
        data[second + 60] ^= 1
        data[second + 400] ^= 1
        file.seek(0)
        file.write(data)
    records = w.read_warc(spark, path)
    gaps = records.filter("gap is not null").collect()
    assert [(g["offset"], g["length"]) for g in gaps] == [(second, third - second)]
    assert gaps[0]["file"].endswith(name)
    assert w.archived_pages(records).count() == 29


def test_time_of_gzip_members_is_linear():
    """Bytes that are copied from one member to the next would show as four times the time for twice the members."""
    draw = random.Random(1)
    members = [gzip.compress(plain_record(i, draw.randbytes(20_000))) for i in range(50)] * 8
    taken = []
    for n in (len(members) // 2, len(members)):
        data = b"".join(members[:n])
        start = time.process_time()
        assert sum(1 for _ in w.salvage(data)) == n
        taken.append(time.process_time() - start)
    assert taken[1] < 3.2 * taken[0] + 0.2
