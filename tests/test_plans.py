import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe import cli
from locusframe.config import StudyConfig
from locusframe.operators import reshape
from locusframe.plans import layout, resume

CONFIG = StudyConfig()


def study(spark, changed=0):
    """Profiles of four genomes, samples and sizes; ``changed`` alters the counts."""
    data, meta = [], []
    for i in range(8):
        for time in ("pre", "end"):
            s = f"s{i}{time}"
            meta.append((s, "fat" if i < 4 else "control", f"c{i}", time, f"r{i % 4}"))
            for m in "abcd":
                for pos in range(3):
                    a = (i * 3 + pos + changed) % 7 if time == "pre" else (i + 2) % 9
                    data.append((s, m, f"{m}.fa_k", pos, 10, a, 10 - a, 0, 0, 0, "g" if pos else None))
    profiles = spark.createDataFrame(data, "sample_id string, MAG_ID string, contig string, position bigint, total_coverage bigint, A bigint, C bigint, G bigint, T bigint, N bigint, gene_id string")
    samples = spark.createDataFrame(meta, "sample_id string, `group` string, subjectID string, time string, replicate string")
    sizes = spark.createDataFrame([(m, 10) for m in "abcd"], "MAG_ID string, genome_size bigint")
    return profiles, samples, sizes


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_bucketed_chain_has_no_exchange(spark):
    from locusframe.operators import change, frequency

    profiles, samples, sizes = study(spark)
    freq = frequency.nucleotide_frequencies(profiles, samples, sizes, 0.1)
    layout.save_sites(freq, "sites_test", 6)
    means = layout.site_means(spark, "sites_test", CONFIG)
    assert "Exchange" not in means._jdf.queryExecution().executedPlan().toString()
    assert rows(means) == rows(change.mean_changes(change.allele_changes(change.one_sample_each(freq), *CONFIG.timepoints)))
    spark.sql("DROP TABLE sites_test")


def test_resumed_study(spark, tmp_path):
    """A stopped run continues; finished genomes are not read again, half-written ones are replaced; tables are those of one run."""
    whole = resume.run(*study(spark), CONFIG, str(tmp_path / "whole"))

    def stop(batch):
        raise KeyboardInterrupt

    out = str(tmp_path / "parts")
    with pytest.raises(KeyboardInterrupt):
        resume.run(*study(spark), CONFIG, out, 1, after_batch=stop)
    assert resume.finished(spark, out) == {"a"}
    # Leftovers of a genome that isn't finished.
    spark.read.parquet(f"{out}/nuc_freq").where("MAG_ID = 'a'").withColumn("MAG_ID", F.lit("b")).write.mode("append").partitionBy("MAG_ID").parquet(f"{out}/nuc_freq")
    profiles, samples, sizes = study(spark)
    other = study(spark, changed=3)[0]
    seen = []
    parts = resume.run(profiles.where("MAG_ID <> 'a'").unionByName(other.where("MAG_ID = 'a'")), samples, sizes, CONFIG, out, 2, after_batch=seen.append)
    assert seen == [["b", "c"], ["d"]] and resume.finished(spark, out) == set("abcd")
    for name, path in whole.items():
        assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(parts[name])), name
    assert rows(spark.read.parquet(whole["two_sample_unpaired"])) and resume.run(profiles, samples, sizes, CONFIG, out) == parts


def test_density_curves(spark):
    """Against the sum over all values; close for smooth series, with Scott's bandwidth; constant series have none."""
    rng = np.random.default_rng(3)
    series = {"normal": rng.normal(0.5, 0.1, 4000), "uniform": rng.random(300), "two": np.repeat([0.1, 0.9], 50), "one": np.array([0.4]), "same": np.full(9, 0.2)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in series.items() for v in vs] + [("normal", None), (None, 0.1), (None, 0.3)], "label string, p_value double")
    got = reshape.density_curves(df).toPandas()
    assert set(got["label"].dropna()) == {"normal", "uniform", "two"} and (got.groupby("label", dropna=False).size() == 200).all() and got["label"].isna().sum() == 200
    for name in ("normal", "uniform", "two"):
        own, values = got[got["label"] == name].sort_values("point"), series[name]
        width = values.std(ddof=1) * len(values) ** -0.2
        assert np.allclose(own["bandwidth"], width) and np.allclose(own["x"], np.linspace(values.min(), values.max(), 200))
        direct = np.exp(-(((own["x"].to_numpy()[:, None] - values) / width) ** 2) / 2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
        assert np.abs(own["density"] - direct).max() < 0.01 * direct.max()


def test_unknown_genome_is_an_error(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("MAG_ID\tscore_tTest (%)\nm1\t5\n")
    (tmp_path / "g.tsv").write_text("gene_id\tx\ng\t1\n")
    with pytest.raises(SystemExit, match="no genome m9"):
        cli.main(["outliers", "--mag_file", str(tmp_path / "m.tsv"), "--mag_id", "m9", "--gene_file", str(tmp_path / "g.tsv"), "--out_fPath", str(tmp_path / "o.tsv")])


def test_resumed_study_without_rows(spark, tmp_path):
    """No change passes, or no genome is given: the relations are there, typed and empty."""
    from locusframe.plans import queries

    data = "/root/testdata/sf0.001"
    for table in ("lineitem", "supplier"):
        spark.read.parquet(f"{data}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    spark.read.parquet(f"{data}/orders.parquet").withColumn("o_orderdate", F.lit("1998-01-01").cast("timestamp")).write.parquet(str(tmp_path / "orders.parquet"))
    got = queries.queries()["mean_change_resumed"](spark, str(tmp_path))
    assert got.count() == 0 and dict(got.dtypes)["MAG_ID"] == "string"
    profiles, samples, sizes = study(spark)
    for path in resume.run(profiles.where("false"), samples, sizes, CONFIG, str(tmp_path / "none"), tests=False).values():
        assert spark.read.schema("MAG_ID string").parquet(path).count() == 0


def test_tables_are_gone_through_once(spark, monkeypatch):
    """A study over a view of tables gets profiles and samples that are written, so the view is computed once."""
    from __spark_entry__ import SMALL
    from locusframe.plans import filequeries, queries

    class Stop(Exception):
        pass

    seen = []

    def run(profiles, samples, *rest):
        seen.extend((profiles, samples))
        raise Stop

    monkeypatch.setattr(filequeries.study, "run", run)
    with pytest.raises(Stop):
        filequeries.empty_study(spark, SMALL)
    seen.append(queries._freq(spark, SMALL))
    assert len(seen) == 3
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" in plan and "lineitem" not in plan and "l_orderkey" not in plan
