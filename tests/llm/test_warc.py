import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from feedloom.llm import warc
from feedloom.session import fresh_dir, local_path

HTML = [(1, "<p>" + "a" * 200), (2, "<p>" + "a" * 200), (3, None), (4, ""), (5, "short"), (6, "short"),
        (7, "é" * 60), (0, "<p>" + "a" * 200), (None, "<p>" + "a" * 200), (0, "<p>" + "a" * 200), (9, "x\r\n\r\ny" * 20000)]


def store(spark, rows, **options):
    df = spark.createDataFrame([(i, h, "d", 1) for i, h in rows], "page_id long, html string, digest string, n int")
    planned = warc.plan_records(df.repartition(3), "page_id", F.col("html"), F.lit("http://x/\r\ny"))
    folder = fresh_dir(spark, "warc-test")
    return warc.write_archives(planned, folder, **options)


def test_round_trip_with_revisits(spark):
    back = warc.read_archives(store(spark, HTML)).collect()
    assert all(r["error"] is None and r["digest_ok"] for r in back)
    order = lambda x: (x[0], x[1], str(x[2]))
    got = sorted(((r["record_id"].split(":")[-1], r["record_type"], r["refers_to"] and r["refers_to"].split(":")[-1],
                  r["payload_bytes"], r["payload_digest"]) for r in back), key=order)
    want = []
    for i, h in HTML:
        raw = (h or "").encode()
        same = [j for j, x in HTML if x == h and j is not None]
        target = min(same) if len(raw) >= 100 and len([1 for _, x in HTML if x == h]) > 1 else None
        target = None if target == i else target
        want.append((str(i) if i is not None else "null", "revisit" if target is not None else "response",
                     None if target is None else str(target), len(raw), hashlib.sha256(raw).hexdigest()))
    assert got == sorted(want, key=order)
    payload = {r["record_id"].split(":")[-1]: r["payload"] for r in back if r["record_type"] == "response"}
    assert payload["9"] == ("x\r\n\r\ny" * 20000).encode() and payload["7"] == ("é" * 60).encode()


def test_archives_are_bounded_and_one_member_per_record(spark):
    rows = [(i, os.urandom(400).hex()) for i in range(60)]
    manifest = store(spark, rows, archive_bytes=2000).collect()
    assert sum(m["records"] for m in manifest) == 60 and len(manifest) > 10
    with open(local_path(manifest[0]["path"]), "rb") as f:
        data = f.read()
    assert data.count(b"\x1f\x8b\x08") >= manifest[0]["records"]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == manifest[0]["records"]


def test_damage_is_reported_not_raised(spark):
    manifest = store(spark, [(i, f"page {i} " * 50) for i in range(5)]).collect()
    path = local_path(max(manifest, key=lambda m: m["records"])["path"])
    with open(path, "rb") as f:
        data = f.read()
    folder = os.path.dirname(path)
    cases = {"cut": data[:-7], "junk": data + b"not gzip", "frame": gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nx"),
             "nohead": gzip.compress(b"hello"), "empty": b"",
             "wrong": gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Payload-Digest: sha256:00\r\n"
                                    b"Content-Length: 2\r\n\r\nhi\r\n\r\n")}
    for name, raw in cases.items():
        with open(f"{folder}/{name}.gz", "wb") as f:
            f.write(raw)
    got = {}
    for r in warc.read_archives(spark.createDataFrame([(f"{folder}/{n}.gz",) for n in cases], "path string")).collect():
        got.setdefault(os.path.basename(r["path"])[:-3], []).append(r)
    for name in ("cut", "junk", "frame", "nohead"):
        assert got[name][-1]["error"], name
    assert "empty" not in got and got["wrong"][0]["digest_ok"] is False
    assert all(r["error"] is None for r in got["junk"][:-1])


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_members_inflate_incrementally(chunk):
    import io
    raw = [b"a" * 1000, b"", b"xyz" * 5]
    data = b"".join(gzip.compress(r) for r in raw)
    got = list(warc.Members(io.BytesIO(data), chunk))
    assert [b for _, b in got] == raw and got[0][0] == 0 and got[1][0] == len(gzip.compress(raw[0]))


def test_empty_table(spark):
    assert warc.read_archives(store(spark, [])).count() == 0


def test_digests_of_every_kind():
    import base64
    import hashlib

    data = b"payload"
    for kind in ("sha1", "md5", "sha256", "SHA-512"):
        found = hashlib.new(kind.lower().replace("-", ""), data).digest()
        for text in (found.hex(), found.hex().upper(), base64.b32encode(found).decode(), base64.b32encode(found).decode().rstrip("=")):
            assert warc._same(f"{kind}:{text}", data) is True and warc._same(f"{kind}:{text}", b"other") is False
    assert warc._same("sha1:wrong", data) is False and warc._same("crc:12", data) is None
    assert warc._same(None, data) is True and warc._same("", data) is True
    assert [warc._both(a, b) for a, b in ((True, True), (True, None), (None, False), (False, True))] == [True, None, False, False]
