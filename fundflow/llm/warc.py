"""WARC archives of captured pages, and their index by external merge.

``write_archives`` writes one WARC/1.1 record a page, through Spark's text
writer: a record is its header, an empty line and the payload, and the writer's
line separator is the record's end.  Of the captures with equal payloads of
``LEAST_REVISIT`` bytes or more the one with the smallest page id is the response,
the others are revisits without payload that refer to it.

``read_archives`` parses the archives by Content-Length (payloads may hold
anything), checks each response's digest and gives the captures with file and
offset.  ``capture_index`` sorts the captures of each archive into a run on shared
storage, deals the runs by (URL key, timestamp, page id) ranges over tasks, and
merges each task's k runs by a loser tree: a globally ordered capture history.  A
URL with very many captures spans several ranges, as the order goes on within it.

Cases: null html is an empty payload; equal rows are captures of their own (the
first of equal page ids is the response); a null page_id sorts last and is never
referred to unless all are null; a null url is an empty target; blanks, line ends
and control characters in a url are percent-encoded, each as its own, and such a url
is also kept in a header of its own that reading undoes exactly; an empty table gives an empty
archive and index; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_path, written

END = "\r\n\r\n"
LEAST_REVISIT = 100
LAST = (1 << 63) - 1                           # order of a missing page id
UNSAFE = "[\\x00-\\x20\\x7f]"                    # characters a header's URL can't hold
ARCHIVE_BYTES = 128 << 20                      # payload bytes that an archive is to hold
RANGE_ROWS = 200_000                          # captures that one task merges
DATE_0 = 1_600_000_000                         # capture time of page 0; a second per page id
FIELDS = ("page_id long, url string, urlkey string, timestamp string, record_type string, "
          "payload_bytes long, payload_digest string, refers_to long, file string, offset long, "
          "length long, run long, place long")


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, bytes, digest, revisit, refers_to (null for responses) per page.

    Which pages repeat a payload is settled on narrow rows, pre-aggregated by
    digest: a payload that a third of all pages share is an ordinary skewed key of
    a narrow join.  The payloads move once, by page.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.coalesce("page_id", F.lit(LAST)).alias("pid"), "url",
                         F.coalesce("html", F.lit("")).alias("html"),
                         F.octet_length(body).cast("long").alias("bytes"),
                         F.sha2(body, 256).alias("digest"))
    narrow = keyed.filter(F.col("bytes") >= least).groupBy("pid", "digest") \
                  .agg(F.count(F.lit(1)).alias("n"))
    groups = narrow.groupBy(F.col("digest").alias("d")).agg(
        F.sum("n").alias("all"), F.min("pid").alias("first")).filter(F.col("all") > 1)
    member = narrow.join(groups, F.col("digest") == F.col("d")).select(
        F.col("pid").alias("m_pid"), F.col("digest").alias("m_digest"), "first")
    joined = keyed.join(member, (F.col("pid") == F.col("m_pid"))
                        & (F.col("digest") == F.col("m_digest")), "left")
    copy = F.row_number().over(Window.partitionBy("pid", "digest").orderBy("url"))
    later = F.col("first").isNotNull() & ((F.col("pid") != F.col("first")) | (F.col("copy") > 1))
    return joined.withColumn("copy", copy).select(
        "page_id", "url", "html", "bytes", "digest", later.alias("revisit"),
        F.when(later, F.nullif("first", F.lit(LAST))).alias("refers_to"))


def _record_id(page_id: Column) -> Column:
    """A urn:uuid made of the page id's digest: the same page gives the same id."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        F.lit(">"))


def _escaped(url: Column) -> Column:
    """``url`` with every unsafe character percent-encoded."""
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def records_per_archive(pages: DataFrame) -> int:
    """How many records hold ``ARCHIVE_BYTES`` of payload on average."""
    mean = pages.agg(F.avg(F.octet_length(F.coalesce("html", F.lit(""))))).first()[0] or 0
    return max(1, int(ARCHIVE_BYTES // max(1, mean)))


def write_archives(captures: DataFrame, path: str, most: int = 0) -> None:
    """Gzipped WARC files of ``captures`` below ``path``, one record a row.

    The partitions are those of the last shuffle, each cut into files of ``most`` records
    (0: no limit), so that files need not grow with the input.
    """
    url = F.coalesce("url", F.lit(""))
    unsafe = url.rlike(UNSAFE)
    target = F.when(unsafe, _escaped(url)).otherwise(url)
    exact = F.when(unsafe, _escaped(F.replace(url, F.lit("%"), F.lit("%25"))))
    date = F.date_format(F.timestamp_seconds(
        F.coalesce("page_id", F.lit(0)) % 1_000_000_000 + DATE_0), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = [
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_id(F.col("page_id"))),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("X-Escaped-URL", exact),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("refers_to")))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("X-Page-Id", F.col("page_id").cast("string")),
        ("X-Refers-To-Page", F.when(F.col("revisit"), F.col("refers_to").cast("string"))),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(F.col("revisit"), "0").otherwise(F.col("bytes").cast("string"))),
    ]
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"),
                        *[F.concat(F.lit(f"{name}: "), value) for name, value in header])
    record = F.concat(lines, F.lit(END),
                      F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    captures.select(record.alias("value")).write.option("lineSep", END) \
            .option("maxRecordsPerFile", most).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and query, lower-cased (SURT form)."""
    try:
        # urlsplit would drop line ends and tabs
        parts = urlsplit(re.sub(UNSAFE, lambda c: f"%{ord(c[0]):02x}", url.strip().lower()))
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    labels = host.removeprefix("www.").split(".")
    return (",".join(reversed(labels)) + (f":{port}" if port else "") + ")" + (parts.path or "/")
            + (f"?{parts.query}" if parts.query else ""))


def parse_archive(data: bytes):
    """(header fields, payload, offset, length) of each record of an uncompressed archive."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(END.encode(), at)
        if stop < 0:
            raise ValueError(f"record at {at} has no end of header")
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                      for line in lines[1:])
        begin = stop + len(END)
        size = int(fields["Content-Length"])
        if data[begin + size:begin + size + len(END)] != END.encode():
            raise ValueError(f"record at {at} does not end after {size} bytes")
        yield fields, data[begin:begin + size], at, begin + size + len(END) - at
        at = begin + size + len(END)


def _captures(file: str, run: int, content: bytes) -> list[dict]:
    """The captures of one archive, sorted by (URL key, timestamp, page id): a run."""
    out = []
    for fields, payload, offset, length in parse_archive(gzip.decompress(content)):
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{file}, record at {offset}: payload does not match its digest")
        page = fields.get("X-Page-Id")
        refers = fields.get("X-Refers-To-Page")
        url = fields.get("WARC-Target-URI", "")
        if "X-Escaped-URL" in fields:
            url = unquote(fields["X-Escaped-URL"])
        out.append({
            "page_id": int(page) if page is not None else None, "url": url, "urlkey": url_key(url),
            "timestamp": re.sub(r"\D", "", fields["WARC-Date"]), "record_type": fields["WARC-Type"],
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest,
            "refers_to": int(refers) if refers is not None else None,
            "file": file, "offset": offset, "length": length, "run": run})
    out.sort(key=_order)
    for place, row in enumerate(out):
        row["place"] = place
    return out


def _order(row: dict) -> tuple:
    page = row["page_id"]
    return row["urlkey"], row["timestamp"], page is None, page or 0, row["run"], row["offset"]


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "refers_to"):
        frame[name] = frame[name].astype("Int64")
    return frame


def read_archives(spark, path: str) -> DataFrame:
    """Captures of the archives below ``path``, each archive a sorted run (FIELDS)."""
    def run(batches):
        for pdf in batches:
            for file, number, content in zip(pdf["path"], pdf["run"], pdf["content"]):
                yield _frame(_captures(file, number, content))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    # an archive is one row of bounded size; a batch holds a few of them
    return files.select(F.col("path"), F.xxhash64("path").alias("run"), "content") \
                .mapInPandas(run, FIELDS)


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k - 1, -1, -1):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """An exhausted run loses; equal keys go by run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:                      # first visit while building: wait for an opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and self.keys[at := self.losers[0]] is not None:
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            self.keys[at] = None if self.heads[at] is None else self.key(self.heads[at])
            self._play(at)


def _merged(batches):
    """Merges the runs of one task; its rows come sorted by (run, place)."""
    runs: dict[int, list] = {}
    for pdf in batches:
        for row in pdf.astype(object).where(pdf.notna(), None).to_dict("records"):
            runs.setdefault(row["run"], []).append(row)
    out = []
    for row in LoserTree(list(runs.values()), _order):
        out.append(row)
        if len(out) == 5000:
            yield _frame(out)
            out = []
    if out:
        yield _frame(out)


def capture_index(captures: DataFrame) -> DataFrame:
    """All captures in global order of (urlkey, timestamp, page_id): partitions and rows within them.

    There are as many ranges as keep each near ``RANGE_ROWS`` captures, whatever their number.
    """
    runs = written(captures, "capture-runs")
    spark = runs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    return runs.repartitionByRange(parts, "urlkey", "timestamp", F.col("page_id").asc_nulls_last(),
                                   "run", "offset") \
               .sortWithinPartitions("run", "place").mapInPandas(_merged, FIELDS)


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the archives of ``pages`` and gives the merged index read back from them."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(with_revisits(pages), path, records_per_archive(pages))
    return capture_index(read_archives(spark, path))
