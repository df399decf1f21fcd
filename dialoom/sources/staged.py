"""A staged multi-part data set as a data source of its own: spark.read.format("dialoom_staged").options(path=..., limit=...).load().

Positions count rows over the files in the order of their names, as a sequential reader would meet them. Files' footers say how many rows
each row group holds, so partitions know their positions before anything is read, and a limit ends the list of partitions: row groups
beyond it are never opened. Rows without dialogue or speakers count as positions and are then left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Fields of a row and the options that name their columns.
FIELDS = ("dialogue", "speakers", "narrative")


def open_store(path: str):
    """(file system, path in it); paths without a scheme are those of the machine, as for Spark in local mode."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class RowGroup(InputPartition):
    """Rows of a row group up to `rows`; `first` is the position of its first one."""

    path: str
    number: int
    first: int
    rows: int


class StagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.limit = int(options["limit"]) if options.get("limit") is not None else None
        self.name = options.get("name", "").split(":")[0].split("/")[-1]
        self.columns = {f: options.get(f, f) for f in FIELDS}

    def files(self) -> list[str]:
        from pyarrow import fs

        store, root = open_store(self.path)
        if store.get_file_info(root).type == fs.FileType.File:
            return [root]
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        return sorted(f.path for f in found if f.is_file and f.extension == "parquet" and not f.base_name.startswith(("_", ".")))

    def partitions(self) -> list[RowGroup]:
        import pyarrow.parquet as pq

        store, _ = open_store(self.path)
        out, at = [], 0
        for path in self.files():
            if self.limit is not None and at >= self.limit:
                break
            with store.open_input_file(path) as file:
                footer = pq.ParquetFile(file).metadata
            for n in range(footer.num_row_groups):
                rows = footer.row_group(n).num_rows
                use = rows if self.limit is None else min(rows, self.limit - at)
                if use > 0:
                    out.append(RowGroup(path, n, at, use))
                at += rows
        return out or [RowGroup("", 0, 0, 0)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        if not partition.rows:
            return
        store, _ = open_store(self.path)
        left, at = partition.rows, partition.first
        with store.open_input_file(partition.path) as file:
            parts = pq.ParquetFile(file)
            have = set(parts.schema_arrow.names)
            for batch in parts.iter_batches(row_groups=[partition.number], columns=[c for c in self.columns.values() if c in have]):
                batch = batch.slice(0, left)
                yield self.rows(batch, at)
                left, at = left - len(batch), at + len(batch)
                if not left:
                    break

    def rows(self, batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        lists = {}
        for f in ("dialogue", "speakers"):
            c = self.columns[f]
            lists[f] = batch.column(c).cast(pa.list_(pa.string())) if c in batch.schema.names else pa.nulls(len(batch), pa.list_(pa.string()))
        c = self.columns["narrative"]
        about = pc.fill_null(batch.column(c).cast(pa.string()), "") if c in batch.schema.names else pa.array([""] * len(batch), pa.string())
        position = pa.array(range(at, at + len(batch)), pa.int64())
        name = pc.binary_join_element_wise(pa.scalar(self.name), pc.cast(position, pa.string()), "-")
        whole = pa.RecordBatch.from_arrays([name, position, lists["dialogue"], lists["speakers"], about], names=["id", "original_index", *FIELDS])
        full = [pc.fill_null(pc.greater(pc.list_value_length(whole.column(f)), 0), False) for f in ("dialogue", "speakers")]
        return whole.filter(pc.and_(*full))


class StagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dialoom_staged"

    def schema(self) -> str:
        return "id string, original_index long, dialogue array<string>, speakers array<string>, narrative string"

    def reader(self, schema: StructType) -> StagedReader:
        return StagedReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StagedSource)
