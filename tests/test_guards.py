import pytest
from pyspark.sql import functions as F

from locusframe.operators import guards


def pvalues(spark):
    rows = [("k1", 1, 0.1, 0.2), ("k1", 2, None, 0.2), ("k2", 3, None, None), ("k0", 4, 0.5, None)]
    return spark.createDataFrame(rows, "contig string, position bigint, a double, b double").repartition(3)


def test_findings_of_a_job(spark, tmp_path):
    """Rows are counted as the job runs, each once, with the first and the last described; nothing else is read."""
    watch = guards.Watch(pvalues(spark), [guards.partly_missing(["a", "b"], "t"), guards.untested(["a", "b"], "t"), guards.Guard("never", F.col("a") > 9, F.lit("x"))])
    watch.df.groupBy("contig").count().write.parquet(str(tmp_path / "out"))
    assert [(f.name, f.rows, f.first, f.last) for f in watch.findings()] == [("partly missing t", 2, "k0:4", "k1:2"), ("untested t", 1, "k2:3", "k2:3"), ("never", 0, None, None)]
    with pytest.raises(ValueError, match="partly missing t: 2 rows, such as k0:4, k1:2; untested t: 1 rows, such as k2:3"):
        watch.refuse()


def test_run_watched(spark):
    gather, guard = guards.several("sample_id", ["subjectID", "time"])
    good = spark.createDataFrame([("s1", "c1", "pre"), ("s2", "c1", "end"), ("s1", "c1", "pre")], "sample_id string, subjectID string, time string")
    bad = good.unionByName(spark.createDataFrame([("s2", "c2", "end")], good.schema))
    assert guards.run_watched(gather(good), [guard], lambda df: df.collect())[0].rows == 0
    with pytest.raises(ValueError, match="sample_id with several subjectID or time: 1 rows, such as s2"):
        guards.run_watched(gather(bad), [guard], lambda df: df.collect())


def test_empty(spark):
    watch = guards.Watch(pvalues(spark).limit(0), [guards.untested(["a", "b"], "t")])
    watch.df.collect()
    watch.refuse()
