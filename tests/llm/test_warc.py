"""WARC: what is written comes back, transactions are whole, revisits point to their response."""
import hashlib
import io

from edges import SF01
from gridspark.llm import warc as W

PAGES = "page_id long, url string, html string, key string, digest string, payload string, rid string"


def write_and_read(spark, rows, **kw):
    pages = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], PAGES).repartition(3)
    root, manifest = W.write_archives(pages.sortWithinPartitions("page_id"), "page_id", "url", "html", **kw)
    records = W.read_records(spark, root, manifest, with_payload=True)
    return records, W.captures_of_pages(W.assemble(records)).collect()


def test_round_trip_and_edges(spark):
    big, other = "x" * 1500 + "é", "y" * 999
    rows = [(1, "http://a/", big), (2, "http://b/", big), (9, None, big), (3, "http://c/", other), (4, "http://d/", other), (5, "http://e/", None),
            (6, "http://f/\r\nWARC-Type: x", ""), (None, "http://g/", big), (None, None, None), (7, "http://h/", "z" * 300_000), (9, "http://i/", big),
            (8, "http://j/", "\r\n\r\nWARC/1.1\r\n")]
    records, got = write_and_read(spark, rows)
    assert len(got) == len(rows) and records.count() == 3 * len(rows)
    assert records.filter("type = 'response' and not valid").count() == 0
    payloads = {bytes(r.block) for r in records.filter("type = 'response'").collect()}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    want = {}
    for p, _, h in rows:
        raw = (h or "").encode()
        want.setdefault(p, []).append((len(raw), hashlib.sha1(raw).hexdigest()))
    for r in got:
        assert (r.payload_bytes, r.payload_digest) in want[r.page_id]
    copies = [r for r in got if r.payload_bytes == len(big.encode())]
    assert sorted(str((r.page_id, r.record_type, r.refers_to)) for r in copies) == sorted(map(str, [
        (1, "revisit", 9), (2, "revisit", 9), (None, "revisit", 9), (9, "revisit", 9), (9, "response", None)]))
    assert all(r.record_type == "response" and r.refers_to is None for r in got if r not in copies)


def test_empty_table(spark):
    records, got = write_and_read(spark, [])
    assert got == [] and records.count() == 0


def test_files_are_cut_and_nested_rows_whole(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 20_000)
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    root, manifest = W.write_archives(pages, "page_id", "url", "html")
    assert manifest.count() > 3 and manifest.agg({"n_captures": "sum"}).first()[0] == pages.count()
    rows = W.assemble(W.read_records(spark, root, manifest)).collect()
    assert len(rows) == pages.count()
    assert all(r.request and r.response and r.metadata and r.n_requests == r.n_metadata == 1 for r in rows)


def test_assemble_orphans_and_repeats(spark):
    names = W._RECORD
    def rec(i, kind, to=None):
        return (i, kind, to, None, None, None, 0, None, None, None)
    rows = [rec("r1", "response"), rec("r1", "response"), rec("q1", "request", "r1"), rec("q2", "request", "r1"), rec("m9", "metadata", "gone"),
            rec("x", "warcinfo"), rec(None, "response"), rec("q3", "request")]
    got = {r.capture_id: r for r in W.assemble(spark.createDataFrame(rows, names)).collect()}
    assert set(got) == {"r1", "gone"}
    assert got["r1"].request.record_id == "q1" and got["r1"].n_requests == 2 and got["r1"].metadata is None
    assert got["gone"].response is None and got["gone"].metadata.record_id == "m9"


def test_parser_reads_small_pieces(monkeypatch):
    monkeypatch.setattr(W, "READ_BYTES", 7)
    raw = W.record([("WARC-Type", "a")], b"block") + W.record([("WARC-Type", "b")], b"")
    assert [W.parse(m) for m in W.members(io.BytesIO(raw))] == [({"warc-type": "a", "content-length": "5"}, b"block"),
                                                                ({"warc-type": "b", "content-length": "0"}, b"")]
