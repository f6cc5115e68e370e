"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: White space that separates words in most contracts: space and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\f\r"

#: Byte map of the letter-and-digit word rule: A-Z become a-z; 0-9, a-z and all bytes of
#: non-ASCII characters stay; every other byte separates words.
WORD_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
    for b in range(256)
)


def release_memory() -> None:
    """Gives freed memory of a Python worker back to the system.  Workers live on between tasks, and the allocator would keep the
    peak of every batch for as long; called once for each batch."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another allocator
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share: spark.checkpoint.dir of the session.
    Only on one machine (tests) a temporary folder is taken where nothing is set; on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate results on any file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file on its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def cut(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lower_ascii(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, LOWER)


def space_words(c: Column) -> Column:
    """Words of non-space characters; null has none."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def alnum_text(c: Column) -> Column:
    """The letter-and-digit words of a text, A-Z in lower case, joined by one space."""
    spaced = F.regexp_replace(lower_ascii(F.coalesce(c, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.btrim(spaced)


def crc_mod(c: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def hash_unit(c: Column, salt: str) -> Column:
    """A fixed pseudo-random number in [0, 1) for each value."""
    return F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
