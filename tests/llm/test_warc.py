"""Archives: exact round trips, and what is left of them after damage."""

import base64
import gzip
import hashlib
import random
import zlib

from plumbline.llm.warc import ARCHIVE_BYTES, EMPTY_MEMBER, archives, read_archives, record, salvaged, write_archives

ROWS = [("response", str(k), f"http://a.b/{k}", bytes(f"<p>{'x' * (k * 37 % 400)} {k}", "ascii"), None) for k in range(40)]


def kept(data: bytes) -> dict[str, bytes]:
    return {r["record_id"]: r["payload"] for r in salvaged(data) if not r["gap"]}


def gaps(data: bytes) -> list[tuple[int, int]]:
    return [(r["start"], r["length"]) for r in salvaged(data) if r["gap"]]


def test_archives_are_whole_gzip_files_and_read_back():
    data = b"".join(archives(iter(ROWS)))
    assert gzip.decompress(data).count(b"WARC/1.0\r\n") == len(ROWS)
    assert kept(data) == {f"<urn:page:{r[1]}>": r[3] for r in ROWS} and gaps(data) == []
    assert zlib.decompress(EMPTY_MEMBER, 31) == b""
    assert len(list(archives(iter(ROWS), limit=1000))) > 5


def test_large_payload_still_ends_in_a_zero_byte():
    (data,) = archives(iter([("response", "1", "u", b"a" * (17 << 20), None)]))
    assert data[-1] == 0 and data.endswith(EMPTY_MEMBER)
    assert len(kept(data)["<urn:page:1>"]) == 17 << 20 and gaps(data) == []


def test_each_damaged_member_costs_itself_only():
    members = [record(*r) for r in ROWS]
    starts = [sum(map(len, members[:k])) for k in range(len(members) + 1)]
    data, r = b"".join(members), random.Random(5)
    for _ in range(300):
        hit = r.randrange(len(data))
        bad = bytearray(data)
        bad[hit] ^= 1 << r.randrange(8)
        k = next(k for k in range(len(members)) if starts[k] <= hit < starts[k + 1])
        found = kept(bytes(bad))
        rest = {f"<urn:page:{x[1]}>": x[3] for x in ROWS if x[1] != str(k)}
        assert rest.items() <= found.items() and len(found) - len(rest) in (0, 1)
        if len(found) == len(rest):
            assert gaps(bytes(bad)) == [(starts[k], len(members[k]))]
        else:  # a byte of the member's own header that says nothing about the record
            assert found[f"<urn:page:{k}>"] == ROWS[k][3] and gaps(bytes(bad)) == []


def test_lost_pieces_junk_and_cut_ends():
    members = [record(*r) for r in ROWS]
    junk = b"\x1f\x8b\x08" * 50 + b"WARC/1.0\r\nnothing\r\n\r\n"
    data = b"".join(members[:10]) + junk + b"".join(members[10:20]) + members[20][:-30] + b"".join(members[21:-1]) + members[-1][:25]
    assert set(kept(data)) == {f"<urn:page:{k}>" for k in range(39) if k != 20}
    at = sum(map(len, members[:10]))
    assert gaps(data) == [(at, len(junk)), (at + len(junk) + sum(map(len, members[10:20])), len(members[20]) - 30), (len(data) - 25, 25)]


def test_plain_archives_and_payloads_that_look_like_records():
    rows = [("response", "1", "u", b"WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" + b"\x1f\x8b\x08" + bytes(range(256)), None), ("response", "2", "u", b"", None), *ROWS[3:6]]
    plain = [gzip.decompress(record(*r)) for r in rows]
    assert list(kept(b"".join(plain)).values()) == [r[3] for r in rows]
    broken = plain[1][:30] + plain[1][40:]
    data = plain[0] + broken + plain[2] + plain[3][: len(plain[3]) // 2] + plain[4]
    assert set(kept(data)) == {"<urn:page:1>", "<urn:page:3>", "<urn:page:5>"}
    assert gaps(data) == [(len(plain[0]), len(broken)), (len(data) - len(plain[4]) - len(plain[3]) // 2, len(plain[3]) // 2)]
    # All records in one member, whose end is lost: those before it stay.
    one = gzip.compress(b"".join(plain[2:]) * 50, mtime=0)
    assert len([1 for r in salvaged(one[: len(one) - 9]) if not r["gap"]]) >= 140


def test_many_false_starts_take_no_time():
    data = b"WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 30_000
    assert gaps(data) == [(0, len(data))]


def test_pages_round_trip(spark, tmp_path):
    html = ["same", "same", None, "", "é\r\n\r\nWARC/1.0\r\n", "same", "x" * 50, None]
    rows = [(k if k != 5 else None, None if k == 1 else f"http://a/{k}\n", h, "clash") for k, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string")
    pages = pages.union(pages.where("page_id = 6"))
    write_archives(pages, str(tmp_path / "w"))
    found = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read_archives(spark, str(tmp_path / "w")).collect() if not r.gap)
    want = []
    for k, _, h, _ in [*rows, rows[6]]:
        b = (h or "").encode()
        first = min(r[0] for r in rows if (r[2] or "") == (h or "") and r[0] is not None)
        kind = ("response", None) if k == first else ("revisit", f"<urn:page:{first}>")
        want.append((f"<urn:page:{'' if k is None else k}>", *kind, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()))
    assert found == sorted(want, key=lambda x: (x[0], x[1]))
    write_archives(pages.limit(0), str(tmp_path / "none"))
    assert read_archives(spark, str(tmp_path / "none")).count() == 0
    write_archives(pages, str(tmp_path / "far"), least=10)
    assert {r.record_type for r in read_archives(spark, str(tmp_path / "far")).where("payload_bytes < 10").collect()} == {"response"}
    assert ARCHIVE_BYTES < 2**31
