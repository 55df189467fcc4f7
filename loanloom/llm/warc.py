"""WARC archives of pages, and capture histories by an external index merge.

Writing: one record per page. Payloads that repeat are stored once, in the record with the
largest page_id; the others are revisit records that name it. Records are text with CRLF
line ends, so Spark's own text writer puts them into files on any file system, and its
reader cuts those files again at a mark that names the run and stands in every record's
first header line. A record's stated length is checked when it is read.

Index: captures are dealt to ranges of (URL key, timestamp, page). Each range sorts chunks
of its captures into runs on the task's own disk and merges the runs with a loser tree,
which keeps one capture of each run in memory. Ranges in order, and captures in order
within them, are the capture histories of all URLs; a URL that holds much of the data is
split between ranges by timestamp.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.common import cut, partitions, scratch_dir

#: Payloads of fewer bytes are stored with every page.
LEAST_BYTES = 0
#: Records of one archive file, at most.
FILE_RECORDS = 20_000
#: Captures of a sorted run.
RUN_ROWS = 2_000
#: Parts a group of equal payloads is dealt to when its pages look up their response.
PARTS = 16
BASE32, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CDX = T.StructType(
    [T.StructField("urlkey", T.StringType()), T.StructField("captured", T.StringType()),
     T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
     T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
     T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType())]
)


def base32_sha1(payload: str) -> str:
    """Bare upper-case base32 of the SHA-1: 20 bits, five hexadecimal digits, at a time."""
    groups = ", ".join(
        f"lpad(conv(substring(sha1({payload}), {1 + 5 * i}, 5), 16, 32), 4, '0')" for i in range(8)
    )
    return f"translate(concat({groups}), '{DIGITS}', '{BASE32}')"


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed and joined by commas, then path and query."""
    host = f"lower(regexp_extract({url}, '://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
    rest = f"lower(regexp_extract({url}, '://[^/?#]*([^#]*)', 1))"
    return f"concat(array_join(reverse(split({host}, '[.]')), ','), ')', {rest})"


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, captured, html and what the record says, one row per page.

    Equal payloads are found by length and digest. The largest page_id of each group
    is the response; if rows repeat that page_id, each of them is one. Rows without
    page_id are responses. Groups are formed by digests alone, a large one in PARTS tasks; pages
    meet the decision about them by page, so no payload gathers the html of its copies.
    """
    body = pages.selectExpr(
        "CAST(page_id AS BIGINT) AS page_id", "coalesce(url, '') AS url", "coalesce(html, '') AS html"
    ).selectExpr(
        "*", "CAST(octet_length(html) AS BIGINT) AS payload_bytes", "sha2(html, 256) AS same",
        "xxhash64(page_id, url, html) AS _row",
        # The tables give no time of capture: a second for each id from a fixed day on.
        "date_format(timestamp_seconds(1704067200 + coalesce(page_id, 0)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS captured",
    )
    known = cut(
        body.where(f"payload_bytes >= {least_bytes} AND page_id IS NOT NULL")
        .selectExpr("page_id", "same", "payload_bytes", "_row", f"CAST(pmod(_row, {PARTS}) AS INT) AS _part")
    )
    groups = known.groupBy("same", "payload_bytes").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("least"))
    groups = groups.where("least < kept").selectExpr("same", "payload_bytes", "kept", f"explode(sequence(0, {PARTS - 1})) AS _part")
    revisits = (
        known.join(groups, ["same", "payload_bytes", "_part"]).where("page_id < kept")
        .selectExpr("_row AS _r", "same AS _same", "page_id AS _page", "kept").distinct()
    )
    both = body.join(revisits, F.expr("_row = _r AND same = _same AND page_id = _page"), "left")
    return both.selectExpr(
        "page_id", "url", "captured", "html", "payload_bytes", f"{base32_sha1('html')} AS payload_digest",
        "IF(kept IS NULL, 'response', 'revisit') AS record_type", "kept AS refers_to",
    )


def write_archive(pages: DataFrame, path: str, run: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write one WARC record per row under ``path``; ``run`` marks where records begin."""
    line = "'\\r\\n'"
    clean = "replace(replace({0}, '\\r', '%0D'), '\\n', '%0A')"
    head = [
        "concat('WARC-Type: ', record_type)",
        "concat('WARC-Record-ID: <urn:page:', coalesce(CAST(page_id AS STRING), ''), '>')",
        "concat('WARC-Date: ', captured)",
        f"concat('WARC-Target-URI: ', {clean.format('url')})",
        "concat('WARC-Payload-Digest: sha1:', payload_digest)",
        "concat('WARC-Payload-Length: ', payload_bytes)",
        "CASE WHEN refers_to IS NOT NULL THEN concat('WARC-Refers-To: <urn:page:', refers_to, '>') END",
        "CASE WHEN refers_to IS NOT NULL THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' END",
        "'Content-Type: text/html; charset=utf-8'",
        "concat('Content-Length: ', IF(refers_to IS NULL, payload_bytes, 0))",
    ]
    record = (
        f"concat('WARC/1.1', {line}, 'WARC-Run: {run}', {line}, "
        f"concat_ws({line}, {', '.join(head)}), {line}, {line}, IF(refers_to IS NULL, html, ''), {line}) AS value"
    )
    # Packed files are not split, so their size is bounded.
    files = records(pages, least_bytes).selectExpr(record).write.mode("overwrite")
    files.option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").option("lineSep", "\r\n").text(path)


def read_archive(spark, path: str, run: str) -> DataFrame:
    """The records under ``path``: header fields and payload.

    Length and digest of a response are those of the payload as it was read; where its header
    says otherwise, an error is raised. A revisit, which has no payload, has its header's.
    """
    pieces = spark.read.option("lineSep", f"WARC/1.1\r\nWARC-Run: {run}\r\n").text(path).where("trim('\\r\\n ' FROM value) <> ''")
    parts = pieces.selectExpr(
        "substring_index(value, '\\r\\n\\r\\n', 1) AS head",
        "substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + 5) AS rest",
    )
    def field(name: str) -> str:
        return f"regexp_extract(head, '(?m)^{name}: (.*?)\\r?$', 1)"

    out = parts.selectExpr(
        "CAST(nullif(regexp_extract(head, 'WARC-Record-ID: <urn:page:(-?\\\\d*)>', 1), '') AS BIGINT) AS page_id",
        f"{field('WARC-Target-URI')} AS url", f"{field('WARC-Date')} AS captured", f"{field('WARC-Type')} AS record_type",
        f"CAST({field('WARC-Payload-Length')} AS BIGINT) AS payload_bytes",
        "regexp_extract(head, 'WARC-Payload-Digest: sha1:([A-Z2-7]*)', 1) AS payload_digest",
        "CAST(nullif(regexp_extract(head, 'WARC-Refers-To: <urn:page:(-?\\\\d+)>', 1), '') AS BIGINT) AS refers_to",
        f"CAST({field('Content-Length')} AS BIGINT) AS content_length", "rest",
    )
    wrong = "raise_error(concat('record of page ', page_id, ' is damaged: ', octet_length(rest), ' bytes'))"
    cut_out = "CAST(substring(CAST(rest AS BINARY), 1, CAST(content_length AS INT)) AS STRING)"
    whole = out.withColumn(
        "payload", F.expr(f"CASE WHEN octet_length(rest) = content_length + 4 THEN {cut_out} ELSE {wrong} END")
    )
    seen = whole.withColumns(
        {"_bytes": F.expr("CAST(octet_length(payload) AS BIGINT)"), "_digest": F.expr(base32_sha1("payload"))}
    )
    checked = {
        c: F.expr(f"CASE WHEN record_type = 'revisit' THEN {c} WHEN {c} = {own} THEN {own} ELSE {wrong} END")
        for c, own in (("payload_bytes", "_bytes"), ("payload_digest", "_digest"))
    }
    return seen.withColumns(checked).drop("rest", "content_length", "_bytes", "_digest")


def resolved(archive: DataFrame) -> DataFrame:
    """Captures without payload, each revisit with length and digest of the response it names.

    A revisit whose response is missing, or was another one by its own header, is an error.
    A response that much refers to is looked up in PARTS tasks.
    """
    rows = cut(archive.select(*CDX.names[1:]))
    again = rows.where("record_type = 'revisit'")
    named = again.selectExpr("refers_to AS _page").distinct()
    first = rows.where("record_type = 'response'").selectExpr("page_id AS _page", "payload_bytes AS _bytes", "payload_digest AS _digest")
    # Rows may repeat a page_id with other payloads: the header's digest tells which is meant.
    first = first.join(named, "_page", "left_semi").distinct().selectExpr("*", f"explode(sequence(0, {PARTS - 1})) AS _part")
    found = again.withColumn("_mine", F.expr(f"CAST(pmod(xxhash64(page_id), {PARTS}) AS INT)")).join(
        first, F.expr("refers_to = _page AND _mine = _part AND payload_digest = _digest AND payload_bytes = _bytes"), "left"
    )
    wrong = "raise_error(concat('page ', page_id, ' revisits ', refers_to, ', which is missing or another payload'))"
    own = ["page_id", "url", "captured", "record_type"]
    checked = [f"CASE WHEN _digest IS NOT NULL THEN {e} ELSE {wrong} END AS {c}" for e, c in (("_bytes", "payload_bytes"), ("_digest", "payload_digest"))]
    names = CDX.names[1:]
    return rows.where("record_type = 'response'").select(*names).union(
        found.selectExpr(*own, *checked, "refers_to").select(*names)
    )


class LoserTree:
    """Merges sorted iterators: each node keeps the loser, the winner leaves at the top."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs, self.n = runs, len(runs)
        self.heads = [next(run, None) for run in runs]
        self.tree = [-1] * max(self.n, 1)
        for i in range(self.n):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and self.heads[a] is not None
        return self.heads[a] < self.heads[b]

    def _play(self, run: int) -> None:
        """Up from the run's leaf: losers stay, the winner goes on."""
        node, winner = (run + self.n) // 2, run
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.n and (head := self.heads[winner := self.tree[0]]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def _run_file(folder: str, number: int, rows: list[tuple]) -> str:
    name = os.path.join(folder, str(number))
    with open(name, "wb") as file:
        for low in range(0, len(rows), 500):
            pickle.dump(rows[low : low + 500], file)
    return name


def _run_rows(name: str) -> Iterator[tuple]:
    with open(name, "rb") as file:
        while True:
            try:
                yield from pickle.load(file)
            except EOFError:
                return


def _key(row: tuple) -> tuple:
    """Nulls first in every column, so rows always compare."""
    return tuple((v is not None, v if v is not None else 0) for v in row)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of one range in order. Runs are files of the task and go with it."""
    with tempfile.TemporaryDirectory() as folder:
        names, rows = [], []
        for batch in batches:
            rows += map(_key, zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if len(rows) >= RUN_ROWS:
                names.append(_run_file(folder, len(names), sorted(rows)))
                rows = []
        runs = [_run_rows(n) for n in names] + ([iter(sorted(rows))] if rows else [])
        out: list[tuple] = []
        for row in LoserTree(runs):
            out.append(tuple(v if there else None for there, v in row))
            if len(out) == 5000:
                yield _batch(out)
                out = []
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(CDX)
    types = [kinds[f.dataType.simpleString()] for f in CDX]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], CDX.names)


def capture_index(archive: DataFrame) -> DataFrame:
    """Captures in global order of urlkey, captured and page_id, one row per record."""
    rows = resolved(archive).selectExpr(f"{url_key('url')} AS urlkey", *CDX.names[1:])
    n = partitions(archive.sparkSession)
    ranged = rows.repartitionByRange(n, "urlkey", "captured", "page_id")
    return ranged.mapInArrow(_merged, CDX)


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES, path: str | None = None) -> DataFrame:
    """Write an archive, read it back, and return its capture index.

    One row per page: page_id, urlkey, captured, url, record_type, payload_bytes,
    payload_digest, refers_to. Null html is an empty payload, a null url an empty one.
    An empty table gives no rows. Other columns are not read. The archive stays at
    ``path``, by default in the shared folder.
    """
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    run = os.path.basename(path.rstrip("/"))
    write_archive(pages, path, run, least_bytes)
    return capture_index(read_archive(spark, path, run))
