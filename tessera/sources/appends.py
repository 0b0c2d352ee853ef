"""Appends that count once: a Spark data source with a commit file per batch.

``df.write.format("append_once").option("batch", id)`` adds the rows of a batch to a
log.  Tasks write Parquet files under names of their own; the job's commit
creates ``_commits/<batch>.json`` with the list of its files, which exists at most
once.  A batch whose commit file exists is skipped, so a job that is run again
(after a lost driver, or by a retrying scheduler) adds nothing.  Readers see the
files of commit files only: what a failed job or task left is never read, and is
deleted when the job ends.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.pandas.types import from_arrow_schema

from pyarrow import fs

from tessera.sources.stores import create_once, delete_folder, open_store

READ_BYTES = 32 << 20     # bytes of files per task


def _commit_path(at: str, batch: str) -> str:
    return posixpath.join(at, "_commits", f"{quote(batch, safe='')}.json")


@dataclass
class Added(WriterCommitMessage):
    files: list


class OnceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str):
        self.path, self.batch = path, batch
        self.folder = f"part-{uuid.uuid4().hex}"
        store, at = open_store(path)
        store.create_dir(posixpath.join(at, self.folder), recursive=True)

    def _done(self, store, at) -> bool:
        return store.get_file_info(_commit_path(at, self.batch)).type != fs.FileType.NotFound

    def write(self, iterator):
        store, at = open_store(self.path)
        skip, files, out, name, rows = self._done(store, at), [], None, None, 0
        try:
            for batch in iterator:
                if skip or batch.num_rows == 0:
                    continue
                if out is None:
                    name = f"{self.folder}/{uuid.uuid4().hex}.parquet"
                    out = pq.ParquetWriter(store.open_output_stream(posixpath.join(at, name)), batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        if name:
            files.append({"file": name, "rows": rows,
                          "bytes": store.get_file_info(posixpath.join(at, name)).size})
        return Added(files)

    def commit(self, messages):
        store, at = open_store(self.path)
        files = [f for m in messages if m for f in m.files]
        body = json.dumps({"batch": self.batch, "files": files}).encode()
        store.create_dir(posixpath.join(at, "_commits"), recursive=True)
        if not create_once(store, _commit_path(at, self.batch), body):
            self.abort(messages)                      # another run of the batch was first

    def abort(self, messages):
        store, at = open_store(self.path)
        delete_folder(store, posixpath.join(at, self.folder))


class Files(InputPartition):
    def __init__(self, files):
        super().__init__(files)
        self.files = files


def committed_files(path: str) -> list[dict]:
    """``file, rows, bytes, batch`` of all committed batches."""
    store, at = open_store(path)
    out = []
    found = store.get_file_info(fs.FileSelector(posixpath.join(at, "_commits"), allow_not_found=True))
    for info in sorted(found, key=lambda f: f.path):
        if info.base_name.endswith(".json"):
            with store.open_input_stream(info.path) as f:
                c = json.loads(f.read())
            out += [x | {"batch": c["batch"]} for x in c["files"]]
    return out


class OnceReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        out, open_, size = [], [], 0
        for f in committed_files(self.path):
            open_.append(f["file"])
            size += f["bytes"]
            if size >= READ_BYTES:
                out.append(Files(open_))
                open_, size = [], 0
        return out + [Files(open_)] if open_ or not out else out

    def read(self, partition):
        store, at = open_store(self.path)
        for name in partition.files:
            with store.open_input_file(posixpath.join(at, name)) as f:
                yield from pq.ParquetFile(f).iter_batches()


class AppendOnce(DataSource):
    @classmethod
    def name(cls):
        return "append_once"

    def schema(self):
        store, at = open_store(self.options["path"])
        files = committed_files(self.options["path"])
        if not files:
            raise ValueError("nothing was appended yet: give a schema")
        with store.open_input_file(posixpath.join(at, files[0]["file"])) as f:
            return from_arrow_schema(pq.read_schema(f))

    def reader(self, schema):
        return OnceReader(self.options["path"])

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("append_once only appends")
        if not self.options.get("batch"):
            raise ValueError("option batch is missing")
        return OnceWriter(self.options["path"], self.options["batch"])


def append_once(df: DataFrame, path: str, batch: str) -> None:
    """Append the rows of ``df`` as batch ``batch``; nothing if the log holds it."""
    df.sparkSession.dataSource.register(AppendOnce)
    df.write.format("append_once").mode("append").option("batch", batch).save(path)


def read_appended(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Rows of all committed batches, each once."""
    spark.dataSource.register(AppendOnce)
    reader = spark.read.format("append_once")
    return (reader.schema(schema) if schema else reader).load(path)
