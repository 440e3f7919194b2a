"""Feather (Arrow IPC) files as a Spark data source that is split by record batches.

A file's footer lists its record batches, so a file of any size is read by as many tasks as its batches and
size ask for, and a task opens the file, seeks its batches and decodes only the wanted columns. Files are
reached through pyarrow's file systems (local or shared folders, HDFS, S3, GCS by URI); for paths that only
Spark's readers can open, `readers.read_feather` decodes whole files from binary rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PART_BYTES = 64 << 20   # of a file that one task reads


def _store(path: str):
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def feather_files(path: str) -> list[tuple[str, int]]:
    """(place, size) of the Feather files at ``path``, a file or a directory."""
    import pyarrow.fs as pafs
    fs, place = _store(path)
    info = fs.get_file_info(place)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(place, recursive=True)) \
        if info.type == pafs.FileType.Directory else []
    return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.path.endswith(".feather"))


@dataclass
class Batches(InputPartition):
    """Record batches ``first`` to ``last`` (exclusive) of a file."""
    file: str
    first: int
    last: int


class FeatherReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], part_bytes: int):
        self.path, self.names, self.part_bytes = path, names, part_bytes

    def _open(self, file: str):
        import pyarrow.ipc as ipc
        source = _store(self.path)[0].open_input_file(file)
        whole = ipc.open_file(source)
        fields = [whole.schema.get_field_index(n) for n in self.names]
        return ipc.open_file(source, options=ipc.IpcReadOptions(included_fields=sorted(fields)))

    def partitions(self) -> list[Batches]:
        import pyarrow.ipc as ipc
        fs, out = _store(self.path)[0], []
        for file, size in feather_files(self.path):
            with fs.open_input_file(file) as source:  # the footer only
                n = ipc.open_file(source).num_record_batches
            step = max(1, n * self.part_bytes // max(size, 1))
            out += [Batches(file, k, min(k + step, n)) for k in range(0, n, step)]
        return out

    def read(self, partition: Batches) -> Iterator:
        import pyarrow as pa
        reader = self._open(partition.file)
        for k in range(partition.first, partition.last):
            batch = reader.get_batch(k)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in self.names], names=self.names)


class FeatherSource(DataSource):
    """Options: path, and part_bytes."""

    @classmethod
    def name(cls) -> str:
        return "feather_batches"

    def schema(self) -> T.StructType:
        return schema_of(self.options["path"])

    def reader(self, schema: T.StructType) -> FeatherReader:
        return FeatherReader(self.options["path"], schema.fieldNames(), int(self.options.get("part_bytes", PART_BYTES)))


def schema_of(path: str) -> T.StructType:
    """Schema of the first Feather file at ``path``, from its footer."""
    import pyarrow.ipc as ipc
    from pyspark.sql.pandas.types import from_arrow_schema
    files = feather_files(path)
    if not files:
        raise FileNotFoundError(f"No Feather files found in {path}")
    with _store(path)[0].open_input_file(files[0][0]) as source:
        return from_arrow_schema(ipc.open_file(source).schema)


def read_feather_batches(spark: SparkSession, path: str, columns: list[str] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows of the Feather files at ``path``, only ``columns`` of them if given, in a task for every ``part_bytes``
    of record batches."""
    spark.dataSource.register(FeatherSource)
    whole = schema_of(path)
    schema = T.StructType([whole[c] for c in columns]) if columns else whole
    return spark.read.format("feather_batches").schema(schema).option("path", path).option("part_bytes", str(part_bytes)).load()
