"""A data source that reads Parquet files one by one, so that a damaged file stops no other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

NAME = "isolated_parquet"
FILE, ERROR = "_file", "_error"
ADDED = [T.StructField(FILE, T.StringType()), T.StructField(ERROR, T.StringType())]
HELD = 256 << 20  # bytes of a file, decoded, that a task holds
BATCH = 8192  # rows
NO_ROWS = "no rows"


@dataclass
class File(InputPartition):
    path: str


class IsolatedParquet(DataSource):
    """Every Parquet file below ``path`` is a partition: its rows with ``_file``, or one row with ``_file`` and ``_error``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> IsolatedReader:
        return IsolatedReader(self.options["path"], schema)


class IsolatedReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.columns = path, T.StructType([f for f in schema if f.name not in (FILE, ERROR)])

    def partitions(self) -> list[File]:
        system, root = opened(self.path)
        found = system.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        shown = lambda p: not any(part.startswith(("_", ".")) for part in p[len(root) :].split("/"))
        files = sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet") and shown(f.path))
        return [File(path) for path in files]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        """All rows of the file or, if any of it can't be read, none and the error.

        A file that is small once decoded is decoded once and held; a larger one is decoded twice, first for its errors.
        """
        wanted = to_arrow_schema(self.columns)
        try:
            system, _ = opened(self.path)
            with system.open_input_file(partition.path) as stream:
                file = pyarrow.parquet.ParquetFile(stream, page_checksum_verification=True)
                size = sum(file.metadata.row_group(n).total_byte_size for n in range(file.metadata.num_row_groups))
                if not file.metadata.num_rows:
                    raise ValueError(NO_ROWS)
                held = [batch for batch in _batches(file, wanted) if size <= HELD]
        except Exception as error:  # whatever is wrong with it, it is this file's alone
            yield _row(wanted, partition.path, str(error) or type(error).__name__)
            return
        if held:
            yield from (_named(batch, partition.path) for batch in held)
            return
        with system.open_input_file(partition.path) as stream:
            for batch in _batches(pyarrow.parquet.ParquetFile(stream), wanted):
                yield _named(batch, partition.path)


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path.removeprefix("file:")


def _batches(file: pyarrow.parquet.ParquetFile, wanted: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The file's rows in the wanted types; a column it lacks is null."""
    names = [n for n in wanted.names if n in file.schema_arrow.names]
    for batch in file.iter_batches(BATCH, columns=names):
        columns = [batch.column(f.name).cast(f.type) if f.name in names else pa.nulls(batch.num_rows, f.type) for f in wanted]
        yield pa.RecordBatch.from_arrays(columns, schema=wanted)


def _named(batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
    many = batch.num_rows
    names = pa.DictionaryArray.from_arrays(pa.array([0] * many, pa.int32()), pa.array([path])).cast(pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns, names, pa.nulls(many, pa.string())], [*batch.schema.names, FILE, ERROR])


def _row(wanted: pa.Schema, path: str, error: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in wanted], pa.array([path]), pa.array([error])], [*wanted.names, FILE, ERROR])


def read_isolated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all files below ``path`` with ``_file``; a file that can't be read is one row with its ``_error`` too.

    There is a task for each file. Files are opened by Arrow, so the path must be of a file system that it knows.
    """
    spark.dataSource.register(IsolatedParquet)
    nullable = [T.StructField(f.name, f.dataType) for f in schema]  # an error row has nothing in them
    return spark.read.format(NAME).schema(T.StructType([*nullable, *ADDED])).load(path)
