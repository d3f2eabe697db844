import re

from pyspark.sql import functions as F

from locusframe.llm import quality as q


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "x " * 40, "same line here\nsame line here\n\nsame line here\n x",
    "# é* <tag> 100% & more |   x \x0b\x0cy\x1fz", "a b c d e f g a b c d e f g h i j a b c", "w%d " * 3 + " ".join(f"w{i}" for i in range(5000)),
    " ".join(f"v{i % 997}" for i in range(3000)), "l\n" * 300, " ".join(f"u{i}" for i in range(12)) + "\r\nend\r\nend",
]


def test_base_counts(frame):
    """All counts by brute force: nulls, empty, long, repeated rows; other columns stay."""
    docs = frame([(i, t) for i, t in enumerate(TEXTS)] + [(3, "one"), (None, "null id")])
    got = q.with_statistics(docs).withColumn("base_failed", q.base_failed()).collect()
    assert len(got) == len(TEXTS) + 2 and all(r["score"] == "x" and r["__w"] == "x" for r in got)
    for r in got:
        assert (*[r[c] for c in q.COUNTS], r["base_failed"]) == base(r["text"]), r["text"]
        assert all(r[c] is not None and r[c] == r[c] for c in q.RATIOS)


def covers(rule, row):
    return all(row[c.name] >= c.at if c.least else row[c.name] < c.at for c in rule)


def test_decision_list(spark):
    """Learns conjunctions that part the classes on rows it has not seen; the expression gives the first rule."""
    rows = []
    for i in range(1500):
        junk = i % 6 == 0
        mixed = {"symbol_ratio": 0.9 if i % 12 == 0 else 0.0, "upper_ratio": 0.9 if junk and i % 12 else 0.1 + (i % 7) / 100, "mean_word": 3.0 + i % 9}
        rows.append((i, 0 if junk else 1, *[float(mixed.get(n, (i * 37 % 101) / 101)) for n in q.FEATURES]))
    df = spark.createDataFrame(rows, "id long, label int, " + ", ".join(f"{n} double" for n in q.FEATURES)).withColumn("grow", F.col("id") % 5 < 3).cache()
    rules = q.learn(df)
    assert 2 <= len(rules) <= 4 and all(1 <= len(r) <= q.MOST_CONDITIONS for r in rules)
    for r in df.withColumn("rule", q.fired(rules)).withColumn("text", F.expr(q.written_rules(rules))).collect():
        first = next((k for k, rule in enumerate(rules, 1) if covers(rule, r)), None)
        assert r["rule"] == first == r["text"]
        assert (first is not None) == (r["label"] == 0)
    df.unpersist()


def test_a_rule_of_noise_is_not_accepted(spark):
    rows = [(i, i * 7919 % 10 < 2, *[float(i * (k + 3) * 31 % 1009) for k in range(len(q.FEATURES))]) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, bad boolean, " + ", ".join(f"{n} double" for n in q.FEATURES))
    df = df.select("*", F.when(F.xxhash64("id") % 10 == 0, 0).otherwise(1).alias("label"), (F.col("id") % 3 > 0).alias("grow")).cache()
    assert q.learn(df) == [] and q.written_rules([]) == "NULL"
    df.unpersist()


def test_gain_and_best():
    counts = [{"name": "mean_word", "bin": b, "bad": bad, "good": good} for b, bad, good in ((0, 0, 50), (1, 1, 40), (2, 30, 2))]
    gain, condition, bad, good = q._best(counts, {n: [1.0, 2.0] if n == "mean_word" else [] for n in q.FEATURES})
    assert condition == q.Condition("mean_word", True, 2.0) and (bad, good) == (30, 2) and gain > 0


def test_judge(spark, frame):
    """Junk of a kind that labels show goes, held-out rows too; clean texts stay; odd labels teach nothing."""
    clean = lambda i: " ".join(f"word{(i * 31 + k * k) % 4001}" for k in range(30 + i % 40)) + "."
    junk = lambda i: " ".join(f"W{(i * 17 + k * k) % 4001}!!" for k in range(30 + i % 40)).upper()
    rows = [(i, junk(i) if i % 5 == 0 else clean(i)) for i in range(400)] + [(500, None), (501, ""), (None, clean(3)), (502, junk(3)), (502, junk(3))]
    labels = spark.createDataFrame([(i, 0 if i % 5 == 0 else 1) for i in range(0, 400, 1) if i % 2] + [(i, 0) for i in range(0, 400, 10)] + [(7, 1), (None, 0), (9, None), (11, 5), (999, 0)], "doc_id long, quality int")
    judged, rules = q.judge(frame(rows), labels)
    got = judged.collect()
    assert len(rules) == 1 and len(got) == len(rows) and "text" not in judged.columns and "__kept" in judged.columns
    for r in got:
        bad = r["doc_id"] is not None and (r["doc_id"] in (500, 501, 502) or r["doc_id"] % 5 == 0 and r["doc_id"] < 400)
        assert r["kept"] == (not bad) and r["base_failed"] == (r["doc_id"] in (500, 501)), r
    none, no_rules = q.judge(frame(rows), labels.where("false"))
    assert no_rules == [] and none.where("kept = base_failed or rule is not null").count() == 0


def test_empty(spark, frame):
    judged, rules = q.judge(frame([]), spark.createDataFrame([], "doc_id long, quality int"))
    assert rules == [] and judged.collect() == []
