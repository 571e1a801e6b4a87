"""What Parquet footers say of an archive: rows and time spans, without reading its columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.schemas import PARTITION_COLUMNS, PARTITION_FIELDS
from tidelake.session import spread
from tidelake.sources.lake import archive_path
from tidelake.sources.paths import open_in_task

_MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _span_of(held: pq.ParquetFile, column: str) -> tuple[int | None, int | None, int]:
    """(least, greatest, row groups read) of a time column of one file, in microseconds.

    Row groups without statistics (older files, other writers) have this one column read, in batches.
    """
    kind = held.schema_arrow.field(column).type
    stored = held.schema_arrow.names.index(column)
    scale = _MICROS.get(kind.unit) if pa.types.is_timestamp(kind) else None
    ends: list[int] = []
    read = 0
    for group in range(held.metadata.num_row_groups):
        part = held.metadata.row_group(group)
        chunk = part.column(stored)
        known = chunk.statistics if chunk.path_in_schema == column and chunk.physical_type == "INT64" else None
        if scale and known is not None and known.has_min_max:
            ends += [known.min_raw * scale, known.max_raw * scale]
        elif known is not None and known.has_null_count and known.null_count == part.num_rows:
            continue
        elif part.num_rows:
            read += 1
            for batch in held.iter_batches(row_groups=[group], columns=[column]):
                # Zone-less times are UTC.
                times = batch.column(0).cast(pa.timestamp("us"), safe=False).cast(pa.int64())
                found = pc.min_max(times)
                ends += [v for v in (found["min"].as_py(), found["max"].as_py()) if v is not None]
    return min(ends, default=None), max(ends, default=None), read


def footer_spans(
    spark: SparkSession, root: str, dataset: str, ts: str = "event_ts", where: Column | None = None
) -> DataFrame:
    """A row for each Parquet file of an archive: the partition columns, path, rows, min_ts, max_ts, groups_read.

    Tasks read footers only; ``groups_read`` counts the row groups that had no statistics, so that their
    time column was read instead.  ``where`` is over the partition columns and prunes folders.  Null times
    count as rows and are in no span; a file of null times only has a null span.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column("path").to_pylist():
                with open_in_task(name) as handle:
                    held = pq.ParquetFile(handle, coerce_int96_timestamp_unit="us")
                    rows.append((held.metadata.num_rows, *_span_of(held, ts)))
            columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            counts = [pa.array(c, pa.int64()) for c in columns]
            names = ["rows", "min_us", "max_us", "groups_read"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[*batch.schema.names, *names])

    folders = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PARTITION_FIELDS)
    files = (
        spark.read.format("binaryFile")
        .schema(f"{_BINARY_FILE}, {folders}")
        .option("pathGlobFilter", "*.parquet")
        .load(archive_path(root, dataset))
    )
    listed = spread((files if where is None else files.where(where)).select(*PARTITION_COLUMNS, "path"))
    shape = f"{folders}, path string, rows bigint, min_us bigint, max_us bigint, groups_read bigint"
    return listed.mapInArrow(read, shape).select(
        *PARTITION_COLUMNS, "path", "rows",
        F.timestamp_micros("min_us").alias("min_ts"), F.timestamp_micros("max_us").alias("max_ts"), "groups_read",
    )


def footer_stats(
    spark: SparkSession, root: str, dataset: str, ts: str = "event_ts", where: Column | None = None
) -> DataFrame:
    """``partition_stats`` of a stored archive from its footers; a partition whose files hold no rows gives none."""
    return (
        footer_spans(spark, root, dataset, ts, where)
        .where(F.col("rows") > 0)
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
    )
