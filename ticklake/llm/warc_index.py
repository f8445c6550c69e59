"""WARC archives with an external index merge (operator 4).

Writing: each page becomes a WARC 1.1 record. The payload is the html in
UTF-8; of equal payloads (same SHA-1) the largest page_id is the ``response``,
the others are ``revisit`` records that refer to it. Spark's text writer makes
the archives: a record's text plus ``\\r\\n\\r\\n``, the record separator that the
format asks for, so each part file is an archive (gzip, ``.txt.gz`` by Spark's
naming) of a bounded number of records.

Reading back: every archive is parsed by Content-Length. Each task's records
are sorted by URL key and timestamp and written as a *capture run*. The runs
are then merged: ranges of the key space go to tasks (ranges are cut on URL
key, timestamp and page_id together, so one hot URL splits), and in each task
a loser tree merges its slices of the k runs into globally ordered capture
histories.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, partitions_for, stored
from ticklake.session import scratch_path

MIN_BYTES = 0
_NULL_GROUP = "4001"
RECORDS_PER_FILE = 500
RANGE_ROWS = 100_000
# Fixed value: capture time of page 0; page_id counts seconds from it.
FIRST_CAPTURE = 1704067200

_NL = "\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits as four groups of eight digits."""
    hex_ = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hex_, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then the rest, ASCII lower case;
    empty for null."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1))


def record_id(page_id: Column) -> Column:
    """``<urn:uuid:...>`` that holds the page_id; a third group of 4001 stands for null."""
    hex_ = F.lower(F.lpad(F.hex(F.coalesce(page_id, F.lit(0))), 16, "0"))
    third = F.when(page_id.isNull(), _NULL_GROUP).otherwise("4000")
    return F.concat(
        F.lit("<urn:uuid:00000000-0000-"), third, F.lit("-"), F.substring(hex_, 1, 4), F.lit("-"), F.substring(hex_, 5, 12), F.lit(">")
    )


def decide(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` with payload, payload_bytes, digest, record_type, refers_to.

    Of payloads of at least ``min_bytes`` the largest page_id responds (null
    counts as smallest; rows that repeat that page_id all respond). The winner
    per digest is found with map-side aggregation and joined back between two
    plain exchanges, so a payload that a third of all pages share is split.
    """
    own = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("payload")
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("bigint"),
        "digest": base32_sha1(F.col("payload").cast("binary")),
    })
    # stored: the join below then reads plain exchanges
    top = stored(own.groupBy("digest").agg(F.max("page_id").alias("top")), "responses")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("top"))
    return own.join(top, "digest").select(
        "page_id", "url", "payload", "payload_bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("top")).alias("refers_to"),
    )


def record_text(decided: DataFrame) -> DataFrame:
    """One WARC record per row, without its closing ``\\r\\n\\r\\n``."""
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_NL}Content-Type: text/html; charset=utf-8{_NL}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(_NL + _NL),
    )
    # a revisit keeps the HTTP header and leaves out the payload
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    seconds = F.least(F.greatest(F.coalesce("page_id", F.lit(0)), F.lit(0)), F.lit(200_000_000_000)) + FIRST_CAPTURE
    date = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_NL))
    head = F.concat_ws(
        "",
        F.lit("WARC/1.1" + _NL),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", date),
        line("WARC-Target-URI", uri),  # null url: no such line
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", record_id(F.col("refers_to"))), line("WARC-Profile", F.lit(_REVISIT)))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_NL),
    )
    return decided.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Gzip WARC files under ``path``, at most ``records_per_file`` records each."""
    (
        record_text(decide(pages, min_bytes)).write.option("lineSep", _NL + _NL)
        .option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)
    )


def parse_archive(data: bytes):
    """(offset, headers, block) of each record of one archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(_NL)
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if lines[0] != "WARC/1.1" or len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"damaged WARC record at byte {at}")
        yield at, head, block
        at = end + 8 + size


def _page_of(record: str) -> int | None:
    *_, third, high, low = record.strip("<>").split("-")
    n = int(high + low, 16)
    return None if third == _NULL_GROUP else n - (1 << 64) if n >> 63 else n


_CAPTURE = (
    "url string, captured_at string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, digest_ok boolean, file string, offset long"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One capture per record of the archives under ``path``. ``digest_ok``: a
    response's payload has the stated digest and length. ``offset`` counts
    bytes of the unzipped archive."""
    arrow = arrow_schema(_CAPTURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, rows = batch.column(0)[k].as_py(), []
                for offset, head, block in parse_archive(gzip.decompress(batch.column(1)[k].as_py())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                    ok = kind == "revisit" or (len(payload) == size and b32encode(hashlib.sha1(payload).digest()).decode() == digest)
                    to = head.get("WARC-Refers-To")
                    rows.append((
                        head.get("WARC-Target-URI"), head["WARC-Date"], _page_of(head["WARC-Record-ID"]), size, digest, kind,
                        _page_of(to) if to else None, ok, name.rpartition("/")[2], offset,
                    ))
                if rows:  # an empty table leaves an archive without records
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _CAPTURE)


KEY = ("urlkey", "captured_at", "page_id", "file", "offset")


def capture_runs(captures: DataFrame) -> DataFrame:
    """The captures of each task as a run, sorted by KEY and stored."""
    keyed = captures.withColumns({"urlkey": url_key(F.col("url")), "run": F.spark_partition_id()})
    return stored(keyed.sortWithinPartitions(*(F.asc_nulls_first(c) for c in KEY)), "runs")


class LoserTree:
    """Merges k sorted lists: each inner node holds the loser of its match, so
    the next smallest costs one walk from leaf to root."""

    def __init__(self, lists: list[list]):
        self.lists = [x for x in lists if x]
        self.at = [0] * len(self.lists)
        k = len(self.lists)
        self.loser = [-1] * max(k, 1)
        self.head = [x[0] for x in self.lists]
        for leaf in range(k - 1, -1, -1):
            self._play(leaf)

    def _play(self, leaf: int) -> None:
        winner, node, k = leaf, (leaf + len(self.lists)) // 2, len(self.lists)
        while node > 0:
            other = self.loser[node]
            if other < 0:  # first arrival waits for its opponent
                self.loser[node] = winner
                return
            if self._beats(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and x is not None
        return x < y

    def __iter__(self):
        if not self.lists:
            return
        while (head := self.head[w := self.loser[0]]) is not None:
            yield head
            self.at[w] += 1
            self.head[w] = self.lists[w][self.at[w]] if self.at[w] < len(self.lists[w]) else None
            self._play(w)


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The runs merged: rows in global KEY order over the partitions, with
    ``part`` and ``position`` (order inside it)."""
    order = [F.asc_nulls_first(c) for c in KEY]
    schema = "part int, position long, run int, urlkey string, captured_at string, page_id long, file string, offset long"
    schema += ", payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        cols = {c: table.column(c).to_pylist() for c in (*KEY, "run")}
        lists: dict[int, list] = {}
        for i, key in enumerate(zip(*(cols[c] for c in KEY))):
            page = key[2]
            lists.setdefault(cols["run"][i], []).append(((key[0], key[1], page is not None, page or 0, key[3], key[4]), i))
        merged = [i for _, i in LoserTree(list(lists.values()))]
        out = table.take(pa.array(merged)).append_column("position", pa.array(range(len(merged)), pa.int64()))
        yield from out.select(arrow.names).cast(arrow).to_batches(max_chunksize=8192)

    dealt = (
        runs.repartitionByRange(partitions_for(runs.count(), range_rows, 4), *order)
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("run", *order)
    )
    return dealt.select(*(c for c in arrow.names if c != "position")).mapInArrow(run, schema)


def capture_histories(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Archive ``pages`` (page_id, url, html), read back, merge the index.

    Null html is an empty payload; a null url has an empty key; rows with a
    null page_id are archived and come back with a null page_id; repeated rows
    are archived each; an empty table gives no rows; extra columns are ignored.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages.select("page_id", "url", "html"), path, min_bytes)
    return merge_runs(capture_runs(read_archives(spark, path)))


def op4_warc_index(spark, sf_dir):
    """One capture per page, in the order of the merged index."""
    from ticklake.llm.common import table

    found = capture_histories(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "digest_ok")


# 160 bits as eight groups of five hexadecimal digits, four base32 digits each
_BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * g}, 5))::BIGINT >> {shift}) & 31)::INTEGER, 1)"
    for g in range(8) for shift in (15, 10, 5, 0)
)

ORACLE_SQL = f"""
WITH own AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
    regexp_replace(lower(replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A')), '^[a-z][a-z0-9+.-]*://', '') AS rest
  FROM pages
), decided AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS winner, strlen(payload) AS size FROM own
)
SELECT page_id, size AS payload_bytes, {_BASE32_SQL} AS payload_digest,
  CASE WHEN size < {MIN_BYTES} OR page_id IS NOT DISTINCT FROM winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN size >= {MIN_BYTES} AND page_id IS DISTINCT FROM winner THEN winner END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_extract(rest, '^([^/?#]*)', 1), '.')), ',') || ')'
    || regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1) AS urlkey,
  TRUE AS digest_ok
FROM decided"""
