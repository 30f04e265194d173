import hashlib
import io
import zipfile

import pytest
from compare import duck_bag, spark_bag
from pyspark.sql import functions as F

from eventloom.llm import warc
from eventloom.llm.queries import QUERIES, SQL
from eventloom.llm.zip_reader import ZipReader


def packed(members, method=zipfile.ZIP_STORED, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return out


def test_reads_ranges():
    out = packed({"a/b": b"0123456789", "c": b""}, comment=b"PK\x05\x06 in a comment")
    z = ZipReader(out, len(out.getvalue()))
    assert set(z.members) == {"a/b", "c"} and z.read("a/b", 3, 4) == b"3456" and z.read("c") == b""
    with pytest.raises(ValueError):
        z.read("a/b", 8, 5)


def test_zip64(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    members = {f"m{i}": bytes([i]) * (50 + 40 * i) for i in range(8)}
    out = packed(members)
    assert b"PK\x06\x06" in out.getvalue() and b"PK\x06\x07" in out.getvalue()
    z = ZipReader(out, len(out.getvalue()))
    assert {n: z.read(n) for n in z.members} == members


def test_refuses_what_it_cannot_read():
    out = packed({"a": b"x" * 1000}, zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError):
        ZipReader(out, len(out.getvalue())).read("a")
    with pytest.raises(ValueError):
        ZipReader(io.BytesIO(b"nothing"), 7)


def test_record_checks_its_digest():
    raw = warc.record_bytes(5, "http://a/ä\r\nx: y", b"body", hashlib.sha256(b"body").hexdigest(), 4, None)
    assert warc.parsed(raw)["page_id"] == 5 and "\r" not in warc.parsed(raw)["url"]
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"body", b"b0dy"))


def test_odd_rows(spark):
    same, other = "s" * 100, "é" * 50
    pages = [(3, "u", same), (9, None, same), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (5, "", ""), (6, "u", other), (8, "u", other),
             (7, "u", "x" * 99), (10, "u", "x" * 99), (None, "u", same), (11, "u", "n" * 200_000), (3, "u", same), (12, "u", "a\r\n\r\nb" * 50)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string")
    got = sorted((tuple(r) for r in warc.round_trip(df, archive_bytes=1000).drop("url").collect()), key=str)
    revisits = {9: 3, None: 3, 8: 6}
    want = []
    for page, _, html in pages:
        raw = (html or "").encode()
        kind = "revisit" if page in revisits else "response"
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), kind, revisits.get(page)))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_hot_digests_and_the_rest(spark, monkeypatch):
    pages = [(i, "u", "e" * 200) for i in range(300)] + [(1000 + i, "u", f"{i // 2:03d}" * 40) for i in range(60)] + [(2000 + i, "u", f"n{i:03d}" * 30) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = lambda: sorted(tuple(r) for r in warc.deduplicated(df).select("page_id", "refers_to", "size", "digest", F.col("payload").isNull().alias("bare")).collect())
    want = [(p, 0 if 0 < p < 300 else p - 1 if 1000 <= p < 1060 and p % 2 else None) for p, *_ in pages]
    whole = rows()
    assert [r[:2] for r in whole] == sorted(want) and all(r[4] == (r[1] is not None) for r in whole)
    for most in (1, 5):  # the rest meets by shuffle
        monkeypatch.setattr(warc, "HOT_DIGESTS", most)
        assert rows() == whole


def test_query(spark, sf_dir):
    names, rows = spark_bag(QUERIES["op8_warc"](spark, sf_dir))
    want_names, want, _ = duck_bag(SQL["op8_warc"], sf_dir)
    assert names == want_names and rows == want
