"""A sink with one writer per partition whose output counts once.

:class:`OncePerPartition` is a Python data source (format ``once_parquet``). Every attempt of a task writes a file of its own, batch by batch, and names it in its commit
message; Spark keeps the message of one attempt per partition and hands them to :meth:`OnceWriter.commit`, which writes the manifest and takes away the files
that it does not list. Readers go by the manifest, so that failed, repeated and speculative attempts leave no row twice, and a failed job leaves what was there before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MANIFEST = "_manifest.json"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """What one attempt wrote: its partition, its file (None: no rows) and its rows."""

    partition: int
    file: str | None
    rows: int


@dataclass
class OnceWriter(DataSourceArrowWriter):
    path: str
    schema: StructType
    job: str = field(default_factory=lambda: uuid.uuid4().hex)

    def write(self, iterator) -> Written:
        fs, base = _opened(self.path)
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        name = f"part-{partition:06d}-{self.job}-{uuid.uuid4().hex}.parquet"
        sink, rows, schema = None, 0, to_arrow_schema(self.schema)
        try:
            for batch in iterator:
                if batch.num_rows:
                    if sink is None:
                        fs.create_dir(base, recursive=True)
                        sink = pq.ParquetWriter(f"{base}/{name}", schema, filesystem=fs, compression="zstd")
                    sink.write_table(pa.Table.from_batches([batch]).cast(schema))
                    rows += batch.num_rows
        finally:
            if sink is not None:
                sink.close()
        return Written(partition, name if rows else None, rows)

    def commit(self, messages) -> None:
        """The manifest in one write, then the files of attempts that lost; a file of another job is left to that job."""
        fs, base = _opened(self.path)
        kept = sorted(((m.partition, m.file, m.rows) for m in messages if m is not None and m.file), key=lambda m: m[0])
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{MANIFEST}.{self.job}") as out:
            out.write(json.dumps({"job": self.job, "files": [{"partition": p, "file": f, "rows": n} for p, f, n in kept]}).encode())
        fs.move(f"{base}/{MANIFEST}.{self.job}", f"{base}/{MANIFEST}")
        self._remove({f for _, f, _ in kept})

    def abort(self, messages) -> None:
        """Takes away whatever attempts of this job wrote; an earlier manifest and its files stay."""
        self._remove(set())

    def _remove(self, kept: set[str]) -> None:
        fs, base = _opened(self.path)
        for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
            if f"-{self.job}-" in info.base_name and info.base_name not in kept:
                fs.delete_file(info.path)


class OncePerPartition(DataSource):
    @classmethod
    def name(cls) -> str:
        return "once_parquet"

    def writer(self, schema: StructType, overwrite: bool) -> OnceWriter:
        return OnceWriter(self.options["path"], schema)


def write_once(df: DataFrame, path: str) -> str:
    """``df`` written to ``path``, one file per non-empty partition; replaces what an earlier manifest named there."""
    df.sparkSession.dataSource.register(OncePerPartition)
    df.write.format("once_parquet").mode("append").option("path", path).save()
    return path


def manifest(path: str) -> list[dict]:
    """Partition, file and rows of every file that counts: an entry per partition."""
    fs, base = _opened(path)
    with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())["files"]


def read_once(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that the manifest at ``path`` names, read by Spark."""
    files = [f"{path.rstrip('/')}/{m['file']}" for m in manifest(path)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
