"""WARC archives: exact round trip, duplicates, and damaged archives."""

import base64
import gzip
import hashlib
import io
import re

import pytest

from portolan.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages():
    long = "<p>größe 漢字 </p>" * 40_000
    return [(5, "http://a.org/x", "one"), (3, "http://a.org/y\r\nEvil: 1", "one"), (9, None, "one"), (4, "u", None),
            (2, "v", ""), (7, "w", long), (8, "w", long), (None, "n", "one"), (None, None, "only null"),
            (None, None, "only null"), (6, "r", "repeated"), (6, "r", "repeated"), (10, "r", "repeated"),
            (11, "z", "\r\n\r\n"), (-4, "neg", "WARC/1.1\r\n\r\n")]


def expected(pages, least=0):
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = [j for j, _, h in pages if (h or "").encode() == body]
        first = min([j for j in same if j is not None], default=None)
        again = len(body) >= least and i != first
        out.append((i, len(body), digest(html), "revisit" if again else "response", first if again else None))
    return out


def table(spark, pages):
    return spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, key string, n int")


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, pages, tmp_path, least):
    got = warc.archived(table(spark, pages), str(tmp_path), least_bytes=least).collect()
    assert all(r.error is None for r in got)
    rows = [(r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
             r.refers_to and int(r.refers_to)) for r in got]
    assert sorted(rows, key=str) == sorted(expected(pages, least), key=str)


def test_texts_and_targets_come_back(spark, pages, tmp_path):
    files = warc.archives(table(spark, pages), str(tmp_path), archive_bytes=200)
    assert files.count() > 1 and files.agg({"records": "sum"}).first()[0] == len(pages)
    found = warc.records(files)
    rows = found.collect()
    payloads = sorted(r.payload.decode() for r in rows if r.record_type == "response")
    assert payloads == sorted((p[2] or "") for p, e in zip(pages, expected(pages), strict=True) if e[3] == "response")
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert "http://a.org/y%0D%0AEvil:%201" in {r.target_uri for r in rows}
    assert warc.dangling(found).count() == 0
    alone = found.filter("not (record_type = 'response' and payload_bytes = 3)")
    assert {r.payload_digest for r in found.join(warc.dangling(alone), ["path", "offset"], "left_semi").collect()} == {
        digest("one")}


def test_empty_table(spark, tmp_path):
    assert warc.archived(table(spark, []), str(tmp_path)).count() == 0


def test_members_are_plain_gzip(spark, pages, tmp_path):
    for f in warc.archives(table(spark, pages), str(tmp_path)).collect():
        with open(f.path, "rb") as file:
            raw = file.read()
        plain = gzip.decompress(raw)
        assert plain.count(b"WARC-Record-ID: ") == f.records and len(raw) == f.bytes


def members(texts):
    return [gzip.compress(b"".join(bytes(p) for p in warc.record(str(i), "u", memoryview(t.encode()), None, False, "d")))
            for i, t in enumerate(texts)]


def read(raw):
    return list(warc.read_archive(io.BytesIO(raw)))


@pytest.mark.parametrize("n", [10, 70_000, 300_000])
def test_sequential_reader_places_every_member(n):
    parts = members(["a" * n, "", "b" * (2 * n)])
    rows = read(b"".join(parts))
    assert [(r["offset"], r["size"]) for r in rows] == [
        (sum(map(len, parts[:k])), len(parts[k])) for k in range(3)]
    assert [r["payload_bytes"] for r in rows] == [n, 0, 2 * n] and not any(r.get("error") for r in rows)


def test_damage_is_reported_and_passed_over():
    good = members(["first text", "second text", "third text"])
    plain = gzip.decompress(good[1])

    def around(middle):
        return read(good[0] + middle + good[2])

    def errors(rows):
        assert [rows[0]["payload"], rows[-1]["payload"]] == [b"first text", b"third text"]
        return [r["error"] for r in rows if r.get("error")]

    assert errors(around(gzip.compress(plain.replace(b"second", b"sEcond")))) == ["block digest differs"]
    other = re.sub(rb"WARC-Block-Digest: .*\r\n", b"", plain)
    assert errors(around(gzip.compress(other.replace(b"second", b"sEcond")))) == ["payload digest differs"]
    size = int(re.search(rb"msgtype=response\r\nContent-Length: (\d+)", plain)[1])

    def sized(n):
        return gzip.compress(plain.replace(b"response\r\nContent-Length: %d" % size, b"response\r\nContent-Length: %d" % n))

    assert errors(around(sized(size + 100))) == ["record shorter than its Content-Length"]
    assert errors(around(sized(size - 2)))[0] == "record longer than its Content-Length"
    assert errors(around(gzip.compress(b"no record at all\r\n\r\n"))) == ["unknown first line"]
    broken = bytearray(good[1])
    broken[len(broken) // 2] ^= 0xFF
    assert len(errors(around(bytes(broken)))) >= 1
    assert len(errors(around(b"junk between members"))) == 1
    rows = read(good[0] + good[1][:-9])
    assert rows[0]["payload"] == b"first text" and "truncated" in rows[1]["error"]
    assert read(b"") == []
