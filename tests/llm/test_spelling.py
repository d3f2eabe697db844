import random
import re
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from locusframe.llm import queries
from locusframe.llm import spelling as s


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", max_size=6), max_size=40))
def test_trie(words):
    words = sorted(words)
    got = sorted((words[a], words[b]) for a, b in s.near_in_trie(words))
    assert got == sorted((a, b) for a in words for b in words if near(a, b))


def brute(docs):
    counts = {}
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in counts.items():
        close = sorted((-counts[v], v) for v in counts if near(w, v))
        form = close[0][1] if close and -close[0][0] >= 10 * n else None
        out[w] = (form, n, len(close), counts[form] if form else None)
    roots = {}
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        roots[w] = at
    return sorted((w, form, roots[w], n, k, fn) for w, (form, n, k, fn) in out.items())


def some_docs(rng, size):
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 10))) for _ in range(40)] + ["commonprefix" + "".join(rng.choice("xyzw") for _ in range(rng.randint(0, 5))) for _ in range(120)]
    spoiled = [w[:i] + rng.choice(["", "q", w[i] + "k"]) + w[i + 1 :] for w in base for i in (0, len(w) // 2, len(w) - 1)]
    chain = ["aaaaaaaa"] * 800 + ["aaaaaaab"] * 60 + ["aaaaaabb"] * 4
    pool = base * 12 + spoiled * 2 + chain
    return [(i, " ".join(rng.choice(pool).upper() if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randint(0, 400)))) for i in range(size)]


def test_query_and_oracle(spark, tmp_path):
    """By brute force and by SQL: nulls, empty and long texts, long words, ties, repeated rows, split partitions."""
    docs = [*some_docs(random.Random(3), 60), (None, "nulltext nulltext"), (900, None), (901, ""), (902, "short Wörds only"), (7, "repeated repeated"), (7, "repeated repeated")]
    long = "z" * 3000
    docs += [(910, f"{long} {long} {long}y {long}y x{long[:50]} {long[:50]}"), (911, f"Ärger×÷ö {long[:50]} x{long[:50]} " * 3 + "wordword " * 20_000)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(docs)
    got = sorted(map(tuple, queries.op12_spelling(spark, str(tmp_path)).collect()))
    assert got == want and any(r[1] and r[2] != r[1] for r in want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(s.ORACLE).fetchall()) == want
    vocab = s.vocabulary(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    again = s.variants(vocab, most=60).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, again.collect())) == want


def test_hot_prefix_is_split(spark):
    """A prefix that all words share: no partition of many letters is left whole, and no pair is lost."""
    rng = random.Random(5)
    words = sorted({"prefixes" + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 6))) for _ in range(600)})
    got = s.near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), most=100).collect()
    assert sorted((r["word"], r["near"]) for r in got) == sorted((a, b) for a in words for b in words if near(a, b))


def test_empty(spark, frame):
    assert s.variants(s.vocabulary(frame([]))).collect() == []
    assert s.variants(s.vocabulary(frame([(1, "a few short words")]))).collect() == []
