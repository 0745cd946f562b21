"""WARC archives of captured pages, read back through an external merge of their sorted indexes.

Writing is one projection and Spark's text writer with the record terminator as line separator, so a
lost executor only repeats its task and the committer keeps files whole.  Reading parses each archive file
into one index run sorted by (URL key, capture time, id).  Runs are dealt by ranges of that key (a hot URL spreads over
ranges by time), and each range merges its runs with a loser tree; ranges in order are the whole history.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import shared_path, staged, table
from riskframe.session import ship_package

END = "\r\n\r\n"
RECORDS_PER_FILE = 4000
INDEX = ("run string, pos long, urlkey string, captured string, page_id long, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits at a time become four digits of base 32."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one WARC record per row of ``pages(page_id, url, html)`` into gzip files under ``path``.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is the response and the
    others revisit it; rows that repeat that id are responses too.  Null html is an empty payload, a
    null url gives no target header, a null id is written as ``null`` and sorts below all ids.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", base32_sha1(F.encode("html", "UTF-8"))).withColumn("n", F.octet_length("html"))
    # Only payloads that occur more than once need a look-up; the table of their heads is small and pre-aggregated.
    heads = (p.where(F.col("n") >= min_bytes).groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("head"), F.count("*").alias("c"))
             .where("c > 1").select("of", "head"))
    p = p.join(heads, (F.col("digest") == F.col("of")) & (F.col("n") >= min_bytes), "left")
    revisit = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    urn = lambda c: F.concat(F.lit("<urn:x-capture:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    seconds = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))
    date = F.date_format(F.expr("timestamp_ntz'2001-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))), F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("head")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string")))
    record = F.concat(header, F.lit(END), http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    (p.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: captures of a host and of a page sort together."""
    try:
        u = urlsplit(url)
        host = (u.hostname or "").lower()
    except ValueError:
        return url
    return ",".join(reversed(host.split("."))) + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def parse_archive(data: bytes) -> Iterator[tuple]:
    """(urlkey, captured, page_id, type, refers_to, payload bytes or None, digest) of every record of one archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:head].decode("utf-8").split("\r\n")[1:])
        start, size = head + 4, int(fields["Content-Length"])
        body = data.index(b"\r\n\r\n", start) + 4
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        number = lambda x: None if x is None or x == "<urn:x-capture:null>" else int(x[15:-1])
        n = None
        if kind == "response":
            payload = data[body : start + size]
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
            n = len(payload)
        captured = "".join(c for c in fields["WARC-Date"] if c.isdigit())
        yield (url_key(fields.get("WARC-Target-URI", "")), captured, number(fields["WARC-Record-ID"]), kind,
               number(fields.get("WARC-Refers-To")), n, digest)
        at = start + size + 4


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted index run per archive file."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows = sorted(parse_archive(zlib.decompress(content.as_py(), 31)), key=_order)
            if rows:
                run = path.as_py().rsplit("/", 1)[-1]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run] * len(rows)), pa.array(range(len(rows)), pa.int64()), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()),
                     pa.array(cols[6], pa.string())],
                    names=[x.split()[0] for x in INDEX.split(", ")])


class LoserTree:
    """k-way merge of sorted sequences: each inner node keeps the loser of its match, so the next winner costs one
    path of about log2(k) comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.head = [key(r[0]) if r else None for r in runs]
        self.loser = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        if self.head[a] is None or self.head[b] is None:
            return self.head[b] is None and (self.head[a] is not None or a < b)
        return (self.head[a], a) < (self.head[b], b)

    def _play(self, i: int) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            other = self.loser[node]
            if other < 0:  # still being built: wait here for the other side
                self.loser[node] = winner
                return
            if self._beats(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self):
        while self.k and self.head[w := self.loser[0]] is not None:
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.head[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            self._play(w)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the run pieces of one key range."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    t = pa.Table.from_batches(tables).combine_chunks()
    runs: dict[str, list] = {}
    cols = [t.column(c).to_pylist() for c in ("urlkey", "captured", "page_id", "run", "pos")]
    for i, (key, when, page, run, pos) in enumerate(zip(*cols)):
        runs.setdefault(run, []).append((key, when, page, pos, i))
    pieces = [sorted(runs[r], key=lambda x: x[3]) for r in sorted(runs)]  # pieces of a run come in any order
    order = [x[4] for x in LoserTree(pieces, _order)]
    yield from t.take(pa.array(order, pa.int64())).to_batches(max_chunksize=10_000)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The merged index of all archives under ``path``: captures in order of (URL key, capture time, id).

    ``payload_bytes`` of a revisit are those of the response it refers to.  No archives give an empty index.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = staged(files.mapInArrow(_runs, INDEX), "runs")
    full = (runs.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
            .join(runs.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest", "left_semi"))
    # Sizes are looked up before the merge, whose order is then the order of the result.
    sized = (runs.join(full.withColumnRenamed("payload_digest", "of"), F.col("payload_digest") == F.col("of"), "left")
             .withColumn("payload_bytes", F.coalesce("payload_bytes", "full_bytes")).select(*runs.columns))
    return sized.repartitionByRange("urlkey", "captured", "page_id").mapInArrow(_merge, INDEX)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "captured")


def _digits32() -> str:
    chunk = "CAST('0x' || substr(hex, {0}, 5) AS BIGINT)"
    return " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({chunk.format(5 * i + 1)} >> {s}) & 31 AS BIGINT) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, hex, max(page_id) OVER (PARTITION BY hex) AS head FROM p)
SELECT page_id, payload_bytes, {_digits32()} AS payload_digest,
 CASE WHEN page_id IS NOT DISTINCT FROM head THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id IS NOT DISTINCT FROM head THEN NULL ELSE head END AS refers_to,
 strftime(TIMESTAMP '2001-01-01 00:00:00' + to_seconds(coalesce(page_id, 0) % 1000000000), '%Y%m%d%H%M%S') AS captured
FROM q"""
