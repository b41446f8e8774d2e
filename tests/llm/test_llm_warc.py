import gzip
import hashlib
import random

from conftest import SF_SMALL
from fundflow.llm import warc as S
from fundflow.llm.common import shared_path, table

PAGES = "page_id long, url string, html string"


def test_loser_tree_merges():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(S.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def test_whole_table_round_trip(spark):
    pages = table(spark, SF_SMALL, "pages")
    rows = S.archive(pages).collect()
    html = {r.page_id: r.html.encode() for r in pages.collect()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {
        i: (len(h), hashlib.sha256(h).hexdigest()) for i, h in html.items()}
    order = [(r.urlkey, r.timestamp, r.page_id) for r in rows]
    assert order == sorted(order)              # partition by partition, the whole history


def test_records_and_revisits(spark):
    copy = "x" * 120 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(5, "http://a.b/\r\nq z", copy), (2, None, copy), (9, "u", copy), (None, "n", copy), (7, "u", None),
            (8, "u", ""), (3, "http://WWW.Ex.org:80/P?q=1", "short"), (4, "v", "short"), (2, None, copy),
            (6, "http://[bad", "é😀\n" * 40_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", digest int")
    path = shared_path(spark, "warc-test")
    got = S.archive(pages, path).collect()
    assert len(got) == len(rows)
    size = len(copy.encode())
    kinds = sorted((r.page_id if r.page_id is not None else 99, r.record_type, r.refers_to) for r in got
                   if r.payload_bytes == size)
    assert kinds == [(2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (9, "revisit", 2),
                     (99, "revisit", 2)]
    assert {r.record_type for r in got if r.payload_bytes < 100} == {"response"}
    assert {r.payload_digest for r in got if r.page_id in (7, 8)} == {hashlib.sha256(b"").hexdigest()}
    assert [r.urlkey for r in got if r.page_id == 3] == ["org,ex:80)/p?q=1"]
    # offset and length find each record in its uncompressed archive
    files = {r.path: gzip.decompress(r.content)
             for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()}
    for r in got:
        part = files[r.file][r.offset:r.offset + r.length]
        (fields, payload, _, _), = S.parse_archive(bytes(part))
        assert fields["WARC-Type"] == r.record_type and part.endswith(b"\r\n\r\n")
        assert payload == b"" if r.record_type == "revisit" else hashlib.sha256(payload).hexdigest() == r.payload_digest


def test_runs_are_sorted_and_merge_is_global(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/", f"page {i} " * 30) for i in range(300)], PAGES)
    path = shared_path(spark, "warc-test")
    S.write_archives(S.with_revisits(pages).repartition(5), path)
    captures = S.read_archives(spark, path)
    runs = {}
    for r in captures.collect():
        runs.setdefault(r.run, []).append((r.place, (r.urlkey, r.timestamp, r.page_id)))
    assert len(runs) == 5
    for run in runs.values():
        assert [k for _, k in sorted(run)] == sorted(k for _, k in run)
    keys = [(r.urlkey, r.timestamp, r.page_id) for r in S.capture_index(captures).collect()]
    assert keys == sorted(keys) and len(keys) == 300


def test_empty_table(spark):
    assert S.archive(spark.createDataFrame([], PAGES)).count() == 0


def test_urls_with_control_characters_are_read_back_exactly(spark, scratch):
    urls = ["http://a.org/" + x for x in ("a\tb", "a\nb", "a\r\nb", "a\x7fb", "ab", "a%09b", "a%20b", "a%2520 b", "é\x00ü%", "")]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], PAGES)
    path = scratch + "/warc"
    S.write_archives(S.with_revisits(pages), path)
    rows = {r.page_id: r for r in S.read_archives(spark, path).collect()}
    assert [rows[i].url for i in range(len(urls))] == urls
    assert [rows[i].urlkey for i in range(len(urls))] == [S.url_key(u) for u in urls]
    assert len({rows[i].urlkey for i in range(5)}) == 5


def test_archives_and_ranges_are_cut_by_size(spark, monkeypatch, scratch):
    monkeypatch.setattr(S, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(S, "RANGE_ROWS", 10)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/{i}", f"page {i:03} " * 30) for i in range(200)], PAGES)
    assert S.records_per_archive(pages) == 11 and S.records_per_archive(pages.filter("false")) == 3000
    index = S.archive(pages, scratch + "/warc")
    assert index.rdd.getNumPartitions() >= 20
    rows = index.collect()
    keys = [(r.urlkey, r.timestamp, r.page_id) for r in rows]
    assert keys == sorted(keys) and len(keys) == 200
    files = {}
    for r in rows:
        files[r.file] = files.get(r.file, 0) + 1
    assert max(files.values()) <= 11
