import random
import zlib

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}q" for _ in range(n))
    text, toxic = {}, set()
    for i in range(300):
        body = prose(60)
        if i % 5 == 0:
            body += " nasty rotten nasty"
            toxic.add(i)
        text[i] = f"menu of site\n{body}"
    leak = prose(30)
    text[301] = f"menu of site\n{prose(40)} {leak} {prose(5)}"
    base = prose(80)
    for k in (302, 303, 304):
        text[k] = f"menu of site\n{base} end{k}"
    text |= {305: None, 306: ""}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in text.items()]
    d = str(tmp_path)
    spark.createDataFrame(rows, COLUMNS).repartition(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i in toxic)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, prose(20))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns == list(pipeline.COLUMNS), name
        docs.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first = set(text) - toxic
    assert set(kept[0]) == first
    assert kept[1] == {i: t.replace("menu of site\n", "") if t else t for i, t in text.items() if i in first}
    assert set(kept[2]) == first - {303, 304} and set(kept[3]) == first - {301, 303, 304}
    pieces = pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in pieces} == set(kept[3])
    total = {}
    for r in pieces:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in pieces)
    assert [r["ids_crc32"] for r in pieces if r["doc_id"] == 305] == [zlib.crc32((1).to_bytes(4, "little"))]


def test_one_of_a_large_copy_group_keeps_its_text(spark):
    """Groups of exact and of near copies above the ratio of their source; the menu still goes."""
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}q" for _ in range(n))
    text = {i: f"menu of site\n{prose(60)}" for i in range(40)}
    same = [prose(30) for _ in range(4)]
    text |= {i: "\n".join(["menu of site", *same]) for i in range(100, 120)}
    near = [prose(40) for _ in range(8)]
    for i in range(200, 220):
        lines = list(near)
        lines[i % 8] += f" end{i}"
        text[i] = "\n".join(["menu of site", *lines])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in text.items()], COLUMNS).repartition(3)
    kept = {r["doc_id"]: r["text"] for r in pipeline.one_of_each_group(spark, pipeline.drop_lines(spark, docs, ""), "").collect()}
    assert set(kept) == {*range(40), 100, 200}
    assert kept == {i: text[i].replace("menu of site\n", "") for i in kept}


def test_odd_rows(spark):
    """Null and repeated ids, null columns: rows of one id share a decision, rows without one stay."""
    text = " ".join(f"w{k}q" for k in range(40))
    rows = [(None, text, None, None, None), (None, text, "en", "s", 1), (1, text, "en", "s", 1), (1, text, "en", "s", 1), (1, "other text", "en", None, 1), (2, text + " end", "en", "s", 1), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    lines = pipeline.drop_lines(spark, docs, "")
    assert lines.count() == 7 and lines.columns == list(pipeline.COLUMNS)
    kept = pipeline.one_of_each_group(spark, lines, "").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r["text"]) == sorted([("1", text), ("1", "other text"), ("None", text), ("None", text)])
    assert [r["doc_id"] for r in kept if r["text"] is None] == [3]
    assert {r["doc_id"] for r in pipeline.pack(spark, docs, "").collect()} == {None, 1, 2, 3}


def test_empty_tables(spark, tmp_path):
    d = str(tmp_path)
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    assert pipeline.run(spark, d).collect() == []


def test_line_dedup_is_native(spark, monkeypatch):
    """The stage is DataFrame operations only: no Python of its own, and none to give memory back."""
    import corpus_pipeline

    def refused(_):
        raise AssertionError("Python on the executors")

    monkeypatch.setattr(corpus_pipeline, "given_back", refused)
    docs = spark.createDataFrame([(i, f"same line\nown {i}", "en", "a.com", 10) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_lines(spark, docs, "")
    assert got.count() == 30 and "InArrow" not in got._jdf.queryExecution().executedPlan().toString()
