"""WARC archives of pages, and their capture index merged from locally sorted runs.

Archives are written by Spark's text writer, so any store that Spark writes to will do: each line of its output is a
whole record, and the line end supplies the last CRLF. An archive is closed when the next record would take it beyond
``archive_bytes``, so archives are read back as binary files of bounded size and parsed by Content-Length.
Each archive is sorted by URL key and time, so its index is a locally sorted run. Runs are
cut by a global range partitioning on (URL key, time, page, place in the archives) into ranges of about ``range_rows`` rows, and each range merges
its pieces of the runs with a loser tree over iterators: the ranges in order are the globally ordered capture histories. Only index rows take part, never payloads.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm.shared import shared_dir, staged

INDEX = (
    "page_id long, url string, url_key string, captured timestamp, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, archive string, record_offset long, record_bytes long"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query, without fragment; lower-cased host. Null counts as empty."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def planned(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """pages -> page_id, url, payload, payload_bytes, payload_digest, refers_to (null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1(F.col("payload").cast("binary")).alias("payload_digest")
    )
    same = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
    keepers = staged(same.where("copies > 1").select("payload_digest", "payload_bytes", "keeper"), "warc-keepers")
    return rows.join(keepers, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")).alias("refers_to")
    )


def _crlf_free(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def utc_text(seconds: Column) -> Column:
    """Seconds since 1970 as a UTC date and time, whatever the session's time zone is."""
    day, rest = F.floor(seconds / 86400).cast("int"), F.pmod(seconds, F.lit(86400))
    part = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    return F.concat(
        F.date_from_unix_date(day).cast("string"), F.lit("T"), part(F.floor(rest / 3600)), F.lit(":"), part(F.floor(rest % 3600 / 60)), F.lit(":"), part(rest % 60), F.lit("Z")
    )


def records(rows: DataFrame, first_second: int = 1_700_000_000) -> DataFrame:
    """``planned`` rows -> url_key, page_id, value: the record up to its last CRLF."""
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    seconds = F.lit(first_second) + F.coalesce(F.pmod("page_id", F.lit(1 << 31)), F.lit(0))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), ident(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), utc_text(seconds),
        F.lit("\r\nWARC-Target-URI: "), _crlf_free(F.coalesce("url", F.lit(""))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), ident(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return rows.select(url_key(F.col("url")).alias("url_key"), seconds.alias("seconds"), "page_id", F.concat(head, block, F.lit("\r\n")).alias("value"))


def numbered(rows: DataFrame, archive_bytes: int) -> DataFrame:
    """Adds ``archive``: within a partition, a new number before the record that would take the archive beyond ``archive_bytes``."""
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, archive int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, used = 0, 0
        for batch in batches:
            numbers = []
            for size in pc.binary_length(batch.column("value")).to_pylist():
                if used and used + size + 2 > archive_bytes:
                    archive, used = archive + 1, 0
                used += size + 2
                numbers.append(archive)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], [*batch.schema.names, "archive"])

    return rows.mapInArrow(run, schema)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, archive_bytes: int = 32 << 20) -> None:
    """Write one record per row of ``pages`` into locally sorted archives under ``path``, none beyond ``archive_bytes`` but those of one longer record. No rows write no record."""
    rows = numbered(records(planned(pages, least_bytes)), archive_bytes).sortWithinPartitions("archive", "url_key", "seconds", "page_id")
    rows.select("archive", "value").write.partitionBy("archive").option("lineSep", "\r\n").text(path)


def parse(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, bytes, headers, block) of each record of an archive; raises ValueError where one is broken."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        stop = end + 4 + int(headers["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where it says")
        yield at, stop + 4 - at, headers, content[end + 4 : stop]
        at = stop + 4


def _index_row(archive: str, offset: int, size: int, headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(next(x for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    kind = headers["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"{archive}: the payload at {offset} does not have its digest")
    number = lambda x: int(x[10:-1]) if x and x != "<urn:page:null>" else None
    return number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Date"], kind, length, digest, number(headers.get("WARC-Refers-To", "")), archive, offset, size


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The captures in the archives under ``path``, payload digests of responses checked, in the columns of ``INDEX``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ("page_id", "url", "date", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "record_offset", "record_bytes")
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column("path")[i].as_py()
                rows = [_index_row(archive, *record) for record in parse(batch.column("content")[i].as_py())]
                cols = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], list(names))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path).select("path", "content")
    found = files.mapInArrow(
        run,
        "page_id long, url string, date string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, record_offset long, record_bytes long",
    )
    return found.withColumn("url_key", url_key(F.col("url"))).withColumn("captured", F.to_timestamp("date", "yyyy-MM-dd'T'HH:mm:ssX")).select(
        *[c.split()[0] for c in INDEX.split(", ")]
    )


class LoserTree:
    """Merge k sorted iterators: the loser of each match stays at its node, the winner goes up, so a step costs log2 k comparisons."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1 and building:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def _run_pieces(table: pa.Table) -> list[Iterator[tuple]]:
    """One iterator of (key, row number) for each archive of a table sorted by archive; keys are made as they are asked for."""
    archive = table.column("archive")
    ends = pc.run_end_encode(archive.combine_chunks()).run_ends.to_pylist()
    low = -(1 << 62)

    def piece(start: int, stop: int, at_once: int = 256) -> Iterator[tuple]:
        for at in range(start, stop, at_once):
            part = table.slice(at, min(at_once, stop - at))
            key = [part.column(c).to_pylist() for c in ("url_key", "at", "page_id", "archive", "record_offset")]
            for i, (url, time, page, name, offset) in enumerate(zip(*key, strict=True)):
                yield url, time, low if page is None else page, name, offset, at + i

    return [piece(start, stop) for start, stop in zip([0, *ends], ends, strict=False)]


def merge_histories(index: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """Index rows -> the same rows, globally ordered by (url_key, captured, page_id, archive, record_offset); partitions are the ranges in order. Null page_ids come first.

    No two captures share archive and offset, so even captures that are equal in all else are cut into ranges of about ``range_rows`` rows.
    """
    names = index.columns
    rows = index.withColumn("at", F.unix_micros("captured"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # a range, about range_rows rows of the index
        if not sum(map(len, parts)):
            return
        table, order = pa.Table.from_batches(parts), []
        whole = table.select(names)

        def chosen() -> Iterator[pa.RecordBatch]:
            yield from whole.take(pa.array(order)).combine_chunks().to_batches()
            order.clear()

        for key in LoserTree(_run_pieces(table)):
            order.append(key[-1])
            if len(order) == 8192:
                yield from chosen()
        if order:
            yield from chosen()

    order = ["url_key", "captured", "page_id", "archive", "record_offset"]
    ranges = max(1, -(-index.count() // range_rows))
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order[:3], "record_offset").mapInArrow(run, index.schema)


def archive_pages(pages: DataFrame, path: str | None = None, least_bytes: int = 1000) -> DataFrame:
    """Write the archives (to the shared folder unless ``path`` names another), read them back, and return the merged capture histories.

    A null html is an empty payload and a null url an empty one. Rows repeated with one page_id give a record each, all
    of them responses if theirs is the largest page_id of the payload. Rows without a page_id have records without a number in their names; they
    revisit a larger payload that some page_id has, and are all responses where none has. Other columns are not read. No rows give no rows.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    # parsed once; the range partitioning samples its input before it deals it out
    return merge_histories(staged(read_index(spark, path), "warc-index"))
