"""Result sinks, and intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillwise.session import ensure_checkpoint_dir


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """Write a question's result; each task writes its own files, nothing passes the driver."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once to a new folder under ``spark.checkpoint.dir`` and read back, so that every
    reader (and every retry after a lost executor) starts from whole files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    write_result(df, path, mode="error", partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)
