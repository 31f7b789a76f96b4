"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once; Spark's driver serves the file."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(Path(root.name) / source.relative_to(root)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark takes it to be on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.makeQualified(target).toString()
    local = "file:"     # Hadoop writes file:/a, others read file:///a only
    return f"{local}//{found[len(local):]}" if re.match("file:/[^/]", found) else found


def named(name: str) -> Column:
    """The column of that very name, also with dots or blanks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def remainder(name: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(named(name).cast("string"), F.lit("")).cast("binary")) % divisor


def ids_and_bytes(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc_id``, ``text`` as UTF-8 bytes (so that Arrow copies and decodes nothing)."""
    ship(df.sparkSession)
    return df.select(named(id_col).alias("doc_id"),
                     whole_text(text_col).cast("binary").alias("text"), *more)


def pieces(batch: pa.RecordBatch, most_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most_bytes`` of one column, a row at least in each."""
    start, total = 0, 0
    for i, value in enumerate(batch.column(column)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def record_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema)
