"""What the corpus operators share: tables, intermediate results, sizes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: anything between the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


#: Bytes of an Arrow batch, and rows of one that are Python objects at a time.
BATCH_BYTES, AT_ONCE = 8_000_000, 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only if that is unset and all work is done on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path  # for dropped()
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Remove tables that ``cut`` wrote and nothing reads any more; others are left alone."""
    for df in tables:
        path = getattr(df, "_cut_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bounded(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES in this session: texts can be long, and a batch is held several times over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.sub("[^0-9-]", "", spark.conf.get(name))) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of AT_ONCE rows, for functions that make Python objects of them."""
    for at in range(0, len(batch), AT_ONCE):
        yield batch.slice(at, AT_ONCE)


def tasks(spark: SparkSession) -> int:
    """The number of partitions that shuffles of this session use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column (compared without case) has it."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def word_count(text: Column) -> Column:
    """Number of words (see WORD); null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
