"""Reading and writing notes."""

from __future__ import annotations

import json
import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: folders that a scan leaves out ---
SKIPPED = (".git", ".venv", "__pycache__", "temp", "node_modules", ".idea", ".vscode")
# --- end of fixed values ---


def notes(spark: SparkSession, root: str) -> DataFrame:
    """(path, file, mtime, text) of every .md file below root, in any letter case; byte-order mark and line ends are normalised."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.[mM][dD]")
    decoded = lambda c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))
    path = decoded("_metadata.file_path")
    skipped = "|".join(s.replace(".", r"\.") for s in SKIPPED)
    inner = below(path, root)  # folders above the root may have any name
    text = F.regexp_replace(F.regexp_replace("value", r"^\x{FEFF}", ""), r"\r\n?", "\n")
    out = raw.where(~F.regexp_like(inner, F.lit(rf"(?:^|/)(?:{skipped})/")))
    return out.select(path.alias("path"), decoded("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("mtime"), text.alias("text"))


def below(path: Column, root: str) -> Column:
    """The part of notes' paths behind the root folder."""
    above = (root if "://" in root else os.path.abspath(root)).split("://")[-1].rstrip("/") + "/"
    return F.substring(path, F.locate(above, path) + F.lit(len(above)), F.length(path))


def write_notes(df: DataFrame, out_dir: str, path: str = "path", text: str = "text", source: str | None = None) -> None:
    """Each note as a file under its path (relative) below out_dir, with its source, if that is given, in a folder beside it."""
    from notewarden.sources import datasource

    datasource.register(df.sparkSession)
    columns = [F.col(path).alias("path"), F.col(text).alias("text"), *([F.col(source).alias("source")] if source else [])]
    df.select(*columns).write.format("notes").mode("append").save(out_dir)


def write_pages(lines: DataFrame, out_dir: str, page: str = "page", order: tuple[str, ...] = ("section", "file", "i")) -> None:
    """One folder file=<page> for each page, its lines in order; a long page is several files, whose names ascend."""
    ordered = lines.repartitionByRange(page, *order).sortWithinPartitions(page, *order)
    ordered.select(F.col(page).alias("file"), F.col("line").alias("value")).write.mode("overwrite").partitionBy("file").text(out_dir)


def read_written(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.text(out_dir, wholetext=True).select(F.col("file").cast("string").alias("file"), F.col("value").alias("text"))


def write_text(path: str, text: str) -> None:
    """One small file of the driver, replaced in one step; tables of notes are written by write_notes."""
    target = Path(path).absolute()
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{uuid.uuid4().hex}")
    try:
        part.write_text(text, encoding="utf-8", newline="")
        part.replace(target)
    finally:
        part.unlink(missing_ok=True)


def read_state(path: str) -> dict:
    """A JSON object; a missing or broken file is an empty one."""
    try:
        with open(path, encoding="utf-8") as f:
            state = json.load(f)
    except (OSError, ValueError):
        return {}
    return state if isinstance(state, dict) else {}


def report_json(df: DataFrame) -> DataFrame:
    """Each row as a JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("json"))
