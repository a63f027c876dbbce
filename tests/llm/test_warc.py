import gzip
import hashlib

import pytest

from cabtally.llm.warc import captures, op1_warc_transactions, read_records, records, write_archives

PAGES = "page_id long, url string, html string"


def test_payloads_come_back_whole(spark, folder):
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>" * 40
    rows = [(1, "http://a/x?y#z", long), (2, "u\r\nX: y", long), (3, None, ""), (4, "http://b", None),
            (None, "http://c/", "x" * 1500), (None, "http://c/", "x" * 1500), (9, "http://d/", "s" * 999),
            (8, "http://d/", "s" * 999), (7, "http://e", "\n\n" * 2_000_000)]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], PAGES + ", digest string")
    write_archives(frame, f"{folder}/archives")
    found = read_records(spark, f"{folder}/archives", payloads=True)
    assert found.count() == 3 * len(rows) and found.select("record_id").distinct().count() == 3 * len(rows)
    got = captures(found).collect()
    assert len(got) == len(rows) and all(len(r.requests) == 1 and len(r.metadata) == 1 for r in got)
    full = {r.response.record_id: r.response for r in got}
    for r in got:
        fields = {f.key: f.value for f in r.metadata[0].fields or []}
        payload = full[r.response.refers_to or r.capture_id].payload
        page = fields.get("page_id")
        html = next(h for i, _, h in rows if str(i) == str(page))
        assert bytes(payload).decode() == (html or "")
        assert full[r.response.refers_to or r.capture_id].payload_digest == hashlib.sha1((html or "").encode()).hexdigest()
    kinds = sorted((str({f.key: f.value for f in r.metadata[0].fields or []}.get("page_id")), r.response.type) for r in got)
    assert kinds == sorted(
        [("1", "revisit"), ("2", "response"), ("3", "response"), ("4", "response"), ("None", "response"),
         ("None", "revisit"), ("9", "response"), ("8", "response"), ("7", "response")]
    )


def record(kind, name, *headers, block="", content="application/http; msgtype=request"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *headers, f"Content-Type: {content}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", block]) + "\r\n\r\n"


def test_transactions_are_found_by_identifiers_alone(spark, tmp_path):
    parts = [
        record("warcinfo", "w", content="application/warc-fields", block="a: b\r\n"),
        record("metadata", "m1", "WARC-Concurrent-To: <q1>", content="application/warc-fields", block="k: v\r\nk: w\r\n"),
        record("request", "q1", "WARC-Concurrent-To: <r1>", block="GET / HTTP/1.1\r\n\r\nbody"),
        record("response", "r2", "WARC-Concurrent-To: <q2>", "WARC-Concurrent-To: <m2>", block="HTTP/1.1 200 OK\r\n\r\nhi"),
        record("request", "q2", block="GET /2 HTTP/1.1\r\n\r\n"),
        record("metadata", "m2", content="application/warc-fields"),
        record("response", "r1", "Long-Header: one\r\n two", block="HTTP/1.1 200 OK\r\n\r\nhello"),
        record("request", "lost", "WARC-Concurrent-To: <nowhere>"),
        record("response", "r1", block="HTTP/1.1 200 OK\r\n\r\nhello"),  # written twice
    ]
    halves = ["".join(parts[:4]), "".join(parts[4:])]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p.encode()) for p in parts[:4]))  # members
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(halves[1].encode()))
    got = {r.capture_id: r for r in captures(read_records(spark, str(tmp_path))).collect()}
    assert set(got) == {"<r1>", "<r2>", "<lost>"}
    for number in "12":
        row = got[f"<r{number}>"]
        assert [q.record_id for q in row.requests] == [f"<q{number}>"]
        assert [m.record_id for m in row.metadata] == [f"<m{number}>"]
    assert got["<r1>"].response.payload_bytes == 5 and got["<lost>"].response is None
    assert {f.key: f.value for f in got["<r1>"].metadata[0].fields} == {"k": "v"}


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("cut", range(6))
def test_a_buffer_may_end_anywhere_between_records(pack, cut):
    size = (1 << 20) + 4 - cut  # of the first record with the four bytes after it
    block = "x" * (size - len(record("resource", "a", block="x" * 1_000_000, content="text/plain")) + 1_000_000)
    archive = record("resource", "a", block=block, content="text/plain") + record("resource", "b", block="y", content="text/plain")
    assert archive.index("WARC/1.0", 1) == size
    assert [(r["record_id"], r["payload_bytes"]) for r in records(pack(archive.encode()))] == [("<a>", len(block)), ("<b>", 1)]


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError, match="no WARC record"):
        list(records(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(EOFError):
        list(records(gzip.compress(record("response", "r").encode() * 50)[:-30]))


def test_query_has_a_row_per_page(spark, small, rows_of):
    got = op1_warc_transactions(spark, small).collect()
    pages = dict(rows_of("pages", "page_id, html", small))
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        raw = (pages[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
