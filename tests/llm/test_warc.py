import base64
import hashlib

from courtstats.llm.queries import ORACLES, QUERIES
from courtstats.llm.warc import archived, original_records, parse_records, write_archive
from tests.llm.oracle import same_as_sql

SF = "/root/testdata/sf0.001"
ROWS = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "x", ""),
    (5, "u\r\nX: y", "one\r\n\r\ntwo\r\n\r\nWARC/1.1\r\n"), (6, "http://é/", "ü" * 50_000),
    (None, "n", "alone"), (None, "n", "<p>same</p>"), (7, "r", "rep"), (7, "r", "rep"),
]


def test_query_matches_sql(spark):
    name = "op10_warc_archive"
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name], SF)


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, content string")


def test_edges(spark):
    got = sorted((tuple(r) for r in archived(pages(spark)).collect()), key=str)
    want = []
    for page, _, html in ROWS:
        same = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = page == last
        want.append((page, len(raw), digest, "response" if first else "revisit", None if first else last))
    assert got == sorted(want, key=str)
    assert archived(pages(spark).limit(0)).count() == 0
    assert archived(pages(spark), least_bytes=100).where("record_type = 'revisit'").count() == 0


def test_original_records_round_trip(spark, tmp_path):
    folder = f"{tmp_path}/warc"
    write_archive(pages(spark), folder)
    records = original_records(spark, folder).collect()
    assert len(records) == len(ROWS)
    for r in records:
        ((fields, block),) = parse_records(bytes(r.record))
        if fields["WARC-Type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert fields["WARC-Payload-Digest"] == f"sha1:{digest}"
        else:
            assert block == b""
    assert len({bytes(r.record) for r in records}) == len(ROWS) - 1
