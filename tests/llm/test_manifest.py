import hashlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from locusframe.llm import manifest as m
from locusframe.llm import queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests, fanout):
    """The last node, and for each leaf its path as (left, right)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for k, place in enumerate(at):
            run, own = runs[place // fanout], place % fanout
            paths[k].append(("".join(run[:own]), "".join(run[own + 1 :])))
            at[k] = place // fanout
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def brute(rows, fanout):
    """(group, order, leaf) -> (subroot, root, path), by sorted groups."""
    key = lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])
    groups = [(g, list(rs)) for g, rs in groupby(sorted(rows, key=key), key=lambda r: r[0])]
    made = [tree([r[2] for r in rs], fanout) for _, rs in groups]
    root, upper = tree([x[0] for x in made], fanout)
    return sorted((str(r), sub, root, str(path + up)) for (_, rs), (sub, paths), up in zip(groups, made, upper, strict=True) for r, path in zip(rs, paths, strict=True))


@pytest.mark.parametrize("fanout,hot,others,few", [(3, 100, 5, 20), (2, 33, 1, 0), (3, 1, 0, 20_000), (4, 3, 30, 20_000)])
def test_trees(spark, monkeypatch, fanout, hot, others, few):
    """With levels in one task, in many or both: a hot group, groups of one, null groups and ids, ties, repeated rows, clashing names."""
    monkeypatch.setattr(m, "FEW", few)
    rows = [("hot", i * 7 % 101, sha(f"h{i}")) for i in range(hot)] + [(f"g{k}", i, sha(f"{k}-{i}")) for k in range(others) for i in range(k % 4 + 1)]
    if others:
        rows += [(None, None, sha("n")), (None, 3, sha("m")), ("", 5, sha("e")), ("é", 5, sha("u")), ("hot", 7, sha("tie")), ("hot", 7, sha("tie")), ("hot", None, sha("first"))]
    df = spark.createDataFrame([(*r, "x", "y", "z", {"a": 1}) for r in rows], "source string, doc_id long, leaf string, root string, grp string, i string, more map<string,int>").repartition(5)
    got = m.prove(df, fanout=fanout)
    assert got.columns == ["source", "doc_id", "leaf", "grp", "i", "more", "subroot", "root", "path"]
    out = got.withColumn("folded", m.folded(F.col("leaf"), F.col("path"))).withColumn("bad", m.folded(F.sha2("leaf", 256), F.col("path"))).withColumn("proof", m.proof_digest(F.col("path"))).collect()
    own = lambda r: str((r["source"], r["doc_id"], r["leaf"]))
    assert sorted((own(r), r["subroot"], r["root"], str([tuple(x) for x in r["path"]])) for r in out) == brute(rows, fanout)
    for r in out:
        assert r["folded"] == r["root"] != r["bad"] and (r["grp"], r["i"]) == ("y", "z")
        assert r["proof"] == sha("".join(a + b for a, b in r["path"]))


def test_leaf(spark):
    df = spark.createDataFrame([(1, "é\n", None), (None, "", "-")], "a long, b string, c string")
    got = [r[0] for r in df.select(m.leaf_digest(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [sha("1:13:é\n-"), sha("-0:1:-")]


def test_query_and_oracle(spark, tmp_path):
    """The query's rows by hand and by SQL: tampering, nulls, long texts, repeated rows."""
    texts = [None, "", "plain", "two\nlines\n", "\n", "é\n" * 20_000]
    rows = [(i, texts[i % 6], "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None if i % 7 == 0 else i) for i in range(60)]
    rows += [(5, "tie\n", "en", "s1", 4), (5, "tie\n", "en", "s1", 4), (None, "no\nid", None, "s2", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_manifest(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(m.ORACLE)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(str(spark.createDataFrame([r], got.select(*sorted(got.columns)).schema).first()) for r in want.select(*sorted(want.columns)).fetchall())
    out = got.collect()
    import zlib

    for r in out:
        breaks = [t or "" for i, t, *_ in rows if i == r["doc_id"]]
        cut = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        if all("\n" in t for t in breaks) or not any("\n" in t for t in breaks):
            assert r["verified"] == (not (cut and "\n" in breaks[0]))
    assert {r["verified"] for r in out} == {True, False} and len({r["root"] for r in out}) == 1


def test_empty(spark):
    assert m.prove(spark.createDataFrame([], "doc_id long, source string, leaf string")).collect() == []
