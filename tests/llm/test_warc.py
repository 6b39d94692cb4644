import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.oracle import agree
from textloom.llm import warc


def _rows(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, archive string")


def _run(df, folder, parts=2):
    warc.write_archives(warc.with_dedup(df.repartition(parts)), f"file://{folder}/whole")
    return warc.read_pages(warc.normalise_archives(df.sparkSession, f"file://{folder}/whole", f"file://{folder}/own"), read_records=2)


def test_round_trip_with_revisits(spark, tmp_path):
    html = "<p>same\r\n\r\nWARC/1.1 é</p>"
    df = _rows(spark, [(1, "http://a/\r\nX: y", html, "c"), (5, None, html, "c"), (3, "u", "", "c"), (2, "u", None, "c"), (7, "u", "z" * 50_000, "c"), (None, "u", "lonely", "c"), (9, "u", html + "!", "c")])
    got = {r.page_id: tuple(r)[1:] for r in _run(df, tmp_path).drop("url").collect()}
    size, digest = len(html.encode()), warc.digest32(html.encode())
    assert got == {
        1: (size, digest, "revisit", 5),
        5: (size, digest, "response", None),
        3: (0, warc.digest32(b""), "response", None),
        2: (0, warc.digest32(b""), "revisit", 3),
        7: (50_000, warc.digest32(b"z" * 50_000), "response", None),
        None: (6, warc.digest32(b"lonely"), "response", None),
        9: (size + 1, warc.digest32((html + "!").encode()), "response", None),
    }


def test_repeated_rows_and_empty_table(spark, tmp_path):
    df = _rows(spark, [(4, "u", "x", None)] * 3 + [(2, "u", "x", None)])
    assert sorted((r.page_id, r.record_type) for r in _run(df, tmp_path / "a").collect()) == [(2, "revisit"), (4, "response"), (4, "response"), (4, "response")]
    assert _run(df.limit(0), tmp_path / "b").count() == 0


def test_normaliser_gives_one_member_per_record():
    records = [_bytes(i, b"body %d" % i * 5000) for i in range(5)]
    whole = gzip.compress(b"".join(records))
    out = io.BytesIO()
    index = list(warc.normalise((whole[i : i + 7] for i in range(0, len(whole), 7)), out))
    data = out.getvalue()
    assert sum(p.length for p in index) == len(data) and [p.record_id for p in index] == [f"<urn:page:{i}>" for i in range(5)]
    for p, r in zip(index, records, strict=True):
        assert zlib.decompress(data[p.offset : p.offset + p.length], 31)[-9:] == r[-9:]
        assert warc.record_at(data, p.offset, p.length).block.endswith(b"body %d" % int(p.record_id[10:-1]) * 5000)
    again = io.BytesIO()
    assert [vars(p) for p in warc.normalise([data], again)] == [vars(p) for p in index] and again.getvalue() == data


def test_plain_archives_folded_headers_and_cut_ends():
    plain = b"WARC/1.0\r\nWARC-Type: a\r\n b\r\ncontent-length: 3\r\n\r\nxyz\r\n\r\nWARC/1.0\r\nContent-Length: 9\r\n\r\ncut"
    records = list(warc.read_records(warc.inflate([plain[:10], b"", plain[10:]])))
    assert [(r.get("warc-type"), r.block) for r in records] == [("a b", b"xyz")]


def _bytes(i, payload):
    headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "X-Page-ID": str(i), "WARC-Payload-Digest": f"sha1:{warc.digest32(payload)}"}
    return warc.write_record(headers, b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload)


def test_files_of_every_kind_and_their_indexes(spark, tmp_path):
    odd = bytes(range(256)) + b"\n\nWARC/1.1\r\n" * 3
    records = [_bytes(i, odd * i) for i in range(6)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc.gz").write_bytes(gzip.compress(b"".join(records[:2])))
    (tmp_path / "in" / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records[2:4])))
    (tmp_path / "in" / "plain.warc").write_bytes(b"".join(records[4:]))
    done = warc.normalise_archives(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    rows = warc.read_pages(done).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in rows) == [(i, len(odd) * i, warc.digest32(odd * i)) for i in range(6)]
    for r in done.collect():
        data = open(r.archive.removeprefix("file://"), "rb").read()
        places = [line.split("\t") for line in open(r["index"].removeprefix("file://")).read().splitlines()]
        assert r.records == len(places) == 2 and r.bytes == len(data) == sum(int(p[1]) for p in places) and not r.damaged
        assert {gzip.decompress(data[int(at) : int(at) + int(n)]).count(odd) for at, n, _, _ in places} == {int(p[3][10:-1]) for p in places}


def test_damaged_files(spark, tmp_path):
    whole = b"".join(_bytes(i, b"x" * 50_000) for i in range(4))
    for name, data in (("cut.warc", whole[:-60_000]), ("cut.warc.gz", gzip.compress(whole, 0)[:-60_000]), ("other.warc", whole[: len(whole) // 2] + b"\r\n\r\nno record"), ("text.warc", b"hello\r\n\r\n")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(data)
        with pytest.raises(Exception):
            warc.normalise_archives(spark, f"file://{folder}", f"file://{folder}-out")
        done = warc.normalise_archives(spark, f"file://{folder}", f"file://{folder}-out", strict=False)
        assert [r.damaged for r in done.collect()] == [True]
        assert sorted(r.page_id for r in warc.read_pages(done).collect()) == {"c": [0, 1], "o": [0, 1], "t": []}[name[0]]


def test_urls_come_back_as_they_are(spark, tmp_path):
    urls = ["http://a/b%20c", "http://a/?q=100%&x=é🔥", "http://a/ b", "http://a/x\r\nX-Page-ID: 9", None, "http://a/\ttab"]
    df = _rows(spark, [(i, u, f"page {i}", "c") for i, u in enumerate(urls)])
    got = {r.page_id: r.url for r in _run(df, tmp_path).collect()}
    assert got == dict(enumerate([*urls[:3], "http://a/x%0D%0AX-Page-ID: 9", None, "http://a/%09tab"]))


def test_winners_among_hot_repeated_and_single_payloads(spark):
    rows = [(i, "u", "hot", "c") for i in range(3000)] + [(10_000 + i, "u", f"pair {i // 2}", "c") for i in range(4000)] + [(20_000 + i, "u", f"own {i}", "c") for i in range(500)] + [(None, "u", "pair 0", "c"), (None, "u", None, "c"), (None, "u", "", "c")]
    got = warc.with_dedup(_rows(spark, rows).repartition(5)).collect()
    best = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, rows))
    assert all((-1 if r.winner is None else r.winner) == best[r.html or ""] for r in got)


def test_base32(spark):
    digests = [hashlib.sha1(bytes([i])).digest() for i in range(50)]
    df = spark.createDataFrame([(i, d.hex()) for i, d in enumerate(digests)], "i int, h string")
    assert {r.i: r.b for r in df.select("i", warc.base32(F.col("h")).alias("b")).collect()} == {i: base64.b32encode(d).decode() for i, d in enumerate(digests)}


def test_query_against_sql(spark):
    assert agree(spark, "op10_warc_normalise")
