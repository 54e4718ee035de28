"""Landed pages as a Spark data source: bodies that a fetching job left on shared storage, with what it noted of each.

A page's file is named by the hash of its URL, in one of 256 folders; its notes stand beside it as JSON. A scan lists folders in as many tasks (or fewer, option
``tasks``). A filter on the URL is pushed down to the files that can hold it, so looking up a few pages lists nothing. A body whose SHA-256 is not the noted
one is torn and fails the read. Notes that are missing or broken leave the status unknown, and the file's own time counts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

SCHEMA = "url string, body string, retrieved_at string, status_code int, sha256 string"
NOTES = ".meta.json"
FOLDERS = 256


class TornBody(ValueError):
    """A landed body is not what was noted when it was written."""


def page_name(url: str) -> str:
    digest = hashlib.sha256(url.encode()).hexdigest()
    return f"{digest[:2]}/{digest}"


class Folders(InputPartition):
    """Some folders to be read whole, or some URLs to be looked up."""

    def __init__(self, names: tuple[str, ...], urls: tuple[str, ...] | None = None):
        self.names, self.urls = names, urls


def _store(path: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store, root.rstrip("/")


class PageReader(DataSourceReader):
    def __init__(self, path: str, tasks: int):
        self.path, self.tasks, self.urls = path, tasks, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            asked = {f.value} if isinstance(f, EqualTo) and f.attribute == ("url",) else set(f.value) if isinstance(f, In) and f.attribute == ("url",) else None
            if asked is not None:
                asked.discard(None)
                self.urls = asked if self.urls is None else self.urls & asked
            yield f  # the names are hashes of URLs, so Spark compares them once more

    def partitions(self) -> list[Folders]:
        if self.urls is not None:
            urls = sorted(self.urls, key=page_name)
            return [Folders((), part) for i in range(self.tasks) if (part := tuple(urls[i :: self.tasks]))] or [Folders(())]
        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = sorted(x.base_name for x in found if x.type == fs.FileType.Directory)
        return [Folders(part) for i in range(self.tasks) if (part := tuple(names[i :: self.tasks]))] or [Folders(())]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        store, root = _store(self.path)
        if partition.urls is None:
            infos = (x for name in partition.names for x in store.get_file_info(fs.FileSelector(f"{root}/{name}")) if x.type == fs.FileType.File and "." not in x.base_name)
        else:
            infos = (x for x in store.get_file_info([f"{root}/{page_name(u)}" for u in partition.urls]) if x.type == fs.FileType.File)
        for info in infos:
            with store.open_input_stream(info.path) as source:
                body = source.read()
            try:
                with store.open_input_stream(info.path + NOTES) as source:
                    notes = json.loads(source.read())
            except (OSError, ValueError):
                notes = {}
            digest = hashlib.sha256(body).hexdigest()
            if notes.get("sha256", digest) != digest:
                raise TornBody(f"{info.path} is not the body that was noted")
            when = notes.get("retrieved_at") or (info.mtime or dt.datetime.fromtimestamp(0, dt.UTC)).astimezone(dt.UTC).isoformat()
            values = (notes.get("source_url"), body.decode("utf-8", "replace"), when, notes.get("status_code"), digest)
            types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], ["url", "body", "retrieved_at", "status_code", "sha256"])


class PageWriter(DataSourceArrowWriter):
    """Each page goes to a file of its own under a temporary name and is renamed when it is whole, its notes last; a task that runs twice leaves the same files."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _store(self.path)
        for batch in iterator:
            for row in batch.to_pylist():
                if row["url"] is None:
                    continue
                body, target = (row["body"] or "").encode(), f"{root}/{page_name(row['url'])}"
                notes = {"source_url": row["url"], "retrieved_at": row["retrieved_at"], "status_code": row["status_code"], "sha256": hashlib.sha256(body).hexdigest()}
                store.create_dir(target.rpartition("/")[0], recursive=True)
                for name, content in ((target, body), (target + NOTES, json.dumps(notes).encode())):
                    with store.open_output_stream(name + ".part") as out:
                        out.write(content)
                    store.move(name + ".part", name)
        return WriterCommitMessage()


class LandedPages(DataSource):
    """``spark.read.format("landed_pages").option("path", folder)``; writing appends pages and replaces those of the same URL."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], int(self.options.get("tasks", FOLDERS)))

    def writer(self, schema, overwrite: bool) -> PageWriter:
        return PageWriter(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    """Makes the source known to the session; pushing filters to Python sources is a setting of Spark."""
    spark.dataSource.register(LandedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def land(pages: DataFrame, path: str) -> None:
    """Writes pages (url, body, retrieved_at, status_code); of rows with one URL the last by retrieval, then by body, counts. Null URLs are left out."""
    last = pages.where("url IS NOT NULL").groupBy("url").agg(F.max(F.struct("retrieved_at", "body", "status_code")).alias("p"))
    rows = last.select("url", "p.body", "p.retrieved_at", F.col("p.status_code").cast("int").alias("status_code"), F.lit("").alias("sha256"))
    register(pages.sparkSession)
    rows.write.format("landed_pages").option("path", path).mode("append").save()


def fetch_plan(requests: DataFrame, landed: DataFrame, delay: float = 1.5, retries: int = 3) -> DataFrame:
    """Requests (url, failed, retry_after, failed_at) and landed pages -> url, state, due.

    A landed page is ``cached``. A miss that has failed ``retries`` times is ``failed``; any other is to be fetched, ``new`` at once or as a ``retry`` after the longer of
    the server's ``retry_after`` seconds (unreadable ones count as none) and ``delay`` times two to the number of failures before the last.
    """
    failed = F.coalesce(F.col("failed").cast("int"), F.lit(0))
    wait = F.greatest(F.coalesce(F.col("retry_after").try_cast("double"), F.lit(0.0)), F.lit(delay) * F.pow(F.lit(2.0), failed - 1))
    there = landed.select("url").distinct().withColumn("_there", F.lit(True))
    state = F.when(F.col("_there"), "cached").when(failed >= retries, "failed").when(failed > 0, "retry").otherwise("new")
    due = F.col("failed_at") + F.make_dt_interval(secs=F.round(wait, 3).cast("decimal(18,6)"))
    return requests.join(there, "url", "left").withColumn("state", state).select("url", "state", F.when(F.col("state") == "retry", due).alias("due"))
