import gzip
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from locusframe.sources import tables


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def test_named_files(spark, tmp_path):
    """A file for each group, ordered, of exactly its rows; nulls, odd values and large groups."""
    rows = [(f"s{i % 3}", f"m {i % 2}", i, None if i % 5 == 0 else i, i / 7, "tab\there" if i % 11 == 0 else None if i % 4 == 0 else f"é{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "sample string, genome string, position bigint, n int, share double, note string").repartition(7)
    made = tables.write_files(df, str(tmp_path / "out"), ["sample", "genome"], "{sample}/{sample}_{genome}.tsv.gz", ["position"]).collect()
    assert sum(r["rows"] for r in made) == 5000 and {(r["sample"], r["genome"]) for r in made} == {(f"s{i}", f"m {k}") for i in range(3) for k in range(2)}
    assert files(tmp_path / "out") == sorted(os.path.relpath(r["file_path"], tmp_path / "out") for r in made)
    for r in made:
        want = sorted((x for x in rows if x[:2] == (r["sample"], r["genome"])), key=lambda x: x[2])
        expected = pd.DataFrame([x[2:] for x in want], columns=["position", "n", "share", "note"])
        expected["n"] = pd.Series([x[3] for x in want], dtype=object)
        with gzip.open(r["file_path"], "rt", newline="") as f:
            assert f.read() == expected.to_csv(sep="\t", index=False)


def test_failed_job_leaves_no_file(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 20).cast("string").alias("k"), "id")
    broken = rows.withColumn("v", F.when(F.col("id") == 2999, F.raise_error(F.lit("stop"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="stop"):
        tables.write_files(broken, str(tmp_path / "out"), ["k"], "{k}.tsv")
    with pytest.raises(Exception, match="stop"):
        tables.write_file(broken, str(tmp_path / "one.tsv"))
    assert files(tmp_path) == []


def test_attempts_do_not_meet(spark, tmp_path):
    """Tasks that fail once and run again: each file holds its rows once."""
    mark = tmp_path / "mark"
    mark.mkdir()

    def once(frames):
        from pyspark import TaskContext

        task = TaskContext.get()
        for pdf in frames:
            yield pdf
        (mark / f"{task.partitionId()}-{task.taskAttemptId()}").touch()

    df = spark.range(0, 2000, 1, 4).select((F.col("id") % 5).cast("string").alias("k"), "id").mapInPandas(once, "k string, id bigint")
    for _ in range(2):
        made = tables.write_files(df, str(tmp_path / "out"), ["k"], "{k}.tsv", ["id"]).collect()
        assert sorted(r["rows"] for r in made) == [400] * 5 and files(tmp_path / "out") == [f"{k}.tsv" for k in range(5)]


@pytest.mark.parametrize("name", ["table.tsv", "table.tsv.gz"])
def test_one_file(spark, tmp_path, name):
    """Parts of many tasks are one file of the name, in order, read by pandas and by Spark; written again, it is replaced."""
    path = str(tmp_path / "deep" / name)
    df = spark.range(0, 20_000, 1, 5).select((F.hash("id") % 1000).alias("h"), "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v "), "id")).alias("v"))
    for least in (0, 100):
        tables.write_file(df.where(F.col("id") >= least), path, ["h", "id"])
        assert files(tmp_path) == [f"deep/{name}"]
        got = pd.read_csv(path, sep="\t")
        assert got.equals(got.sort_values(["h", "id"], kind="stable").reset_index(drop=True)) and sorted(got["id"]) == list(range(least, 20_000))
        assert tables.read_table(spark, path, df.schema).exceptAll(df).count() == 0
    tables.write_file(df.where("false"), path)
    assert pd.read_csv(path, sep="\t").shape == (0, 3)
