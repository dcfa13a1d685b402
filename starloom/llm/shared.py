"""What the corpus operators share: stored intermediate tables, text columns, size checks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of ``documents``, which all stages but the last of the pipeline return.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Tables above this are not broadcast; see ``broadcast_if_small``.
BROADCAST_BYTES = 16 * 1024 * 1024


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed, or sent with ``--py-files``, as any other.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


#: Rows of a batch that goes to a Python worker, and the setting that has it.
BATCH_ROWS, BATCH_SETTING = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def modest_batches(spark: SparkSession) -> None:
    """Send whole documents to Python workers in smaller batches, unless the session names a size.

    A batch lies in memory several times over (in Spark, on its way, as strings and as results).
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and all runs on one machine, a folder in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends at the files.

    A lost executor then costs its running tasks only, and a plan that uses the
    table more than once computes it once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_path = path
    return found


#: Spark's setting that deletes the shuffle files of a statement when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files of the write are deleted when it ends.

    For chains of large intermediate tables: otherwise the files of every step stay until the
    driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_END, None)
    conf.set(SHUFFLES_END, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(SHUFFLES_END, before) if before is not None else conf.unset(SHUFFLES_END)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a row without id does not."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % folds == fold, F.lit(False))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def strings_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as strings; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [v or "" for v in values.to_pylist()]


def map_texts(df: DataFrame, per_batch, schema: str) -> DataFrame:
    """Run ``per_batch(batch) -> dict of columns`` over Arrow batches of ``df``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = per_batch(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for c, f in zip((columns[f.name] for f in arrow), arrow)
                    ],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)
