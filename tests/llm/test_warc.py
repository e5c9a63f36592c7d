import hashlib
import random
from collections import Counter

import pytest

from tidegate.llm import warc

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages():
    body = "<p>" + "same é " * 40
    rows = [(i, f"http://x/{i}?a=%20b", f"<p>page {i} " + "w" * (i * 7)) for i in range(40)]
    rows += [(100 + i, "http://copy/", body) for i in range(9)] + [(200, "u", None), (201, None, ""), (202, "a\nb\rc", "x" * 99), (203, "", "x" * 99)]
    return [*rows, (None, "n", body), (None, "n", "own " * 50), (100, "again", body), (300, "crlf", "WARC/1.1\r\nWARC-Type: response\r\n\r\nfake\r\n\r\n" * 5), (301, "long", "y" * 400_000)]


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = page is not None and data in first and page > first[data]
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[data] if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("volume_bytes", [2_000, 1 << 24])
def test_round_trip(spark, frame, pages, tmp_path, volume_bytes):
    path = str(tmp_path / "archives")
    warc.write_archives(frame(pages, SCHEMA), path, volume_bytes=volume_bytes)
    records = warc.read_archives(spark, path).cache()
    assert Counter(map(tuple, warc.page_records(records).collect())) == expected(pages)
    assert records.filter("kind = 'gap'").count() == 0
    bodies = {r["record_id"]: bytes(r["payload"]) for r in records.filter("record_type = 'response'").collect()}
    assert bodies["urn:page:301"] == b"y" * 400_000 and bodies["urn:page:300"].startswith(b"WARC/1.1\r\n")
    uris = {r["record_id"]: r["target_uri"] for r in records.filter("kind = 'record'").collect()}
    assert uris["urn:page:3"] == "http://x/3?a=%20b" and uris["urn:page:202"] == "a%0Ab%0Dc"


def test_empty_table(spark, frame, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(frame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0


def archive(n=30, compressed=True):
    draw = random.Random(2)
    parts, spans, at = [], [], 0
    for i in range(n):
        body = bytes(draw.randrange(256) for _ in range(draw.randint(0, 300)))
        data = warc.record("response", f"urn:page:{i}", body, {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(body).hexdigest()})
        data = warc.member(data) if compressed else data
        parts.append(data)
        spans.append((at, at + len(data)))
        at += len(data)
    return b"".join(parts), spans


def ids(salvage):
    return [int(f.headers["warc-record-id"].strip("<>").rpartition(":")[2]) for f in salvage.records()]


@pytest.mark.parametrize("compressed", [True, False])
def test_damage_costs_only_the_damaged_records(compressed):
    data, spans = archive(compressed=compressed)
    assert ids(warc.Salvage(data)) == list(range(30))
    for hurt in ([4], [0], [29], [4, 5], [3, 17]):
        broken = bytearray(data)
        for i in hurt:
            start, end = spans[i]
            for at in range(start + 12, min(end - 5, start + 40)):
                broken[at] ^= 0xFF
        salvage = warc.Salvage(bytes(broken))
        assert ids(salvage) == [i for i in range(30) if i not in hurt]
        covered = set()
        for start, end, reason in salvage.gaps:
            assert reason
            covered |= set(range(start, end))
        assert covered == {at for i in hurt for at in range(*spans[i])}


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_and_inserted_bytes(compressed):
    data, spans = archive(compressed=compressed)
    cut = warc.Salvage(data[: spans[20][0] + 30])
    assert ids(cut) == list(range(20)) and cut.gaps[0][:2] == (spans[20][0], spans[20][0] + 30)
    start = spans[10][0]
    noisy = warc.Salvage(data[:start] + b"noise \x1f\x8b\x08 WARC/1.0\r\n noise" + data[start:])
    assert ids(noisy) == list(range(30)) and [g[:2] for g in noisy.gaps] == [(start, start + 26)]
    torn = warc.Salvage(data[: spans[7][0] + 120] + data[spans[9][0] + 120 :])
    assert ids(torn) == [i for i in range(30) if i not in (7, 8, 9)]
    assert ids(warc.Salvage(b"")) == [] and ids(warc.Salvage(b"nothing")) == []


def test_wrong_lengths_and_digests_are_quarantined():
    good = warc.record("response", "urn:page:1", b"body", {})
    for bad in (good.replace(b"Content-Length: 4", b"Content-Length: 3"), good.replace(b"Content-Length: 4", b"Content-Length: x"), good.replace(b"WARC-Record-ID", b"Other"), good.replace(b"\r\nContent", b"\r\nWARC-Payload-Digest: sha256:00\r\nContent")):
        salvage = warc.Salvage(bad + good)
        assert ids(salvage) == [1] and salvage.gaps[0][:2] == (0, len(bad))


def test_gaps_are_rows(spark, tmp_path):
    data, spans = archive(5)
    (tmp_path / "a.warc.gz").write_bytes(data[: spans[2][0]] + b"?" * 9 + data[spans[2][0] :])
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [(r["start"], r["end"]) for r in rows if r["kind"] == "gap"] == [(spans[2][0], spans[2][0] + 9)]
    assert sum(r["kind"] == "record" for r in rows) == 5


def one_member(bodies, hurt=()):
    """Records of one member; those in ``hurt`` have a digest that is not theirs."""
    digest = lambda i, body: "00" if i in hurt else hashlib.sha256(body).hexdigest()
    return b"".join(warc.record("response", f"urn:page:{i}", body, {"WARC-Payload-Digest": "sha256:" + digest(i, body)}) for i, body in enumerate(bodies))


def test_a_bad_record_inside_a_member_costs_only_itself():
    bodies = [b"a" * 50, b"WARC/1.1\r\n in a body", b"c" * 70_000, b""]
    text = one_member(bodies, hurt=(1,))
    after = warc.member(one_member([b"next"]))
    salvage = warc.Salvage(warc.member(text) + after)
    assert ids(salvage) == [0, 2, 3, 0]
    first = len(one_member(bodies[:1]))
    assert [g[:2] for g in salvage.gaps] == [(0, len(warc.member(text)))]
    assert salvage.gaps[0][2] == f"record: digest differs (bytes {first} to {len(one_member(bodies[:2], hurt=(1,)))} of the member's content)"


def test_a_member_that_breaks_off_keeps_the_records_before():
    draw = random.Random(8)
    bodies = [bytes(draw.randrange(256) for _ in range(4000)) for _ in range(40)]
    data = warc.member(one_member(bodies))
    cut = warc.Salvage(data[:-200])
    assert ids(cut) == list(range(39)) and cut.gaps == [(0, len(data) - 200, "member: cut off")]
    middle = len(data) // 2
    flipped = data[:middle] + bytes(b ^ 0xFF for b in data[middle : middle + 40]) + data[middle + 40 :]
    salvage = warc.Salvage(flipped + warc.member(one_member([b"next"])))
    got = ids(salvage)
    assert got[-1] == 0 and got[:-1] and set(got[:-1]) <= set(range(40)) and got[:18] == list(range(18))
    assert salvage.gaps and all(start == 0 and end == len(data) for start, end, _ in salvage.gaps)
