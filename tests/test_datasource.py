"""Folders of notes as a data source."""

import pytest
from pyspark.sql import functions as F

from notewarden.sources import datasource, files


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    datasource.register(spark)


def test_round_trip(spark, tmp_path):
    """Two notes of one base name stay two notes, with their sources beside them."""
    rows = [("a/x.md", "# one\n", "source of one"), ("b/x.md", "# two", None), ("c d/ü+%20.md", "", "empty"), ("y.md", "漢字\nline", "s")]
    df = spark.createDataFrame(rows, "path string, text string, source string").repartition(3)
    root = str(tmp_path / "out")
    for _ in range(2):  # a repeated write puts the same files there
        files.write_notes(df, root, source="source")
    got = {r.path: (r.file, r.text) for r in spark.read.format("notes").load(root).collect()}
    sources = {"a/源数据/x.md": "source of one", "c d/源数据/ü+%20.md": "empty", "源数据/y.md": "s"}
    assert got == {p: (p.rsplit("/", 1)[-1], t) for p, t, _ in rows} | {p: (p.rsplit("/", 1)[-1], t) for p, t in sources.items()}
    assert not [p for p in tmp_path.rglob(".*") if not p.name.endswith(".crc")]
    with pytest.raises(Exception, match="not a path below"):
        files.write_notes(spark.createDataFrame([("../x.md", "t")], "path string, text string"), root)
    with pytest.raises(Exception, match="a path and a text"):
        spark.range(1).write.format("notes").mode("append").save(root)


def test_listing(spark, tmp_path):
    """Folders that a scan leaves out are not entered, partitions hold about the given bytes, texts are normalised."""
    for folder in ("a", "a/.git", "node_modules/b", "temp", "deep/er"):
        (tmp_path / folder).mkdir(parents=True)
        for i in range(4):
            (tmp_path / folder / f"n{i}.MD").write_bytes("\ufeff# t\r\nline\rend".encode() + b"x" * 100 * i)
    (tmp_path / "a" / "n.txt").write_text("no")
    df = spark.read.format("notes").option("partitionBytes", "300").load(str(tmp_path))
    rows = df.withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.path for r in rows) == sorted(f"{d}/n{i}.MD" for d in ("a", "deep/er") for i in range(4))
    assert {r.text.rstrip("x") for r in rows} == {"# t\nline\nend"} and all(r.mtime for r in rows)
    assert len({r.p for r in rows}) == 6  # 0 and 1, 2, 3 of each folder, as 3 + 0 is too much
    empty = tmp_path / "none"
    empty.mkdir()
    assert spark.read.format("notes").load(str(empty)).count() == 0
    same = {(r.file, r.text) for r in files.notes(spark, str(tmp_path / "a")).collect()}
    assert same == {(r.file, r.text) for r in rows if r.path.startswith("a/")}
