import random
import zlib

import numpy as np

from locusframe.llm import toxicity as t

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(400)}" + "abc"[rng.randrange(3)] * 2 for _ in range(30)]
        if bad:
            words[rng.randrange(30)] = rng.choice(("nasty", "vilefoo", "vilebar", "Vilebaz"))
            words[rng.randrange(30)] = rng.choice(("nasty", "rotten"))
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(bad)))
    return rows, labels


def test_held_out(spark, frame):
    rows, labels = corpus()
    odd = [(900, None), (901, ""), (None, "nasty rotten nasty"), (902, "nasty rotten " * 20_000), (3, rows[3][1])]
    got = t.score(frame(rows + odd), spark.createDataFrame(labels + [(0, None, None), (None, 0, 1), (4, 0, 0)], LABELS)).collect()
    assert len(got) == len(rows) + len(odd) and len(got[0].__fields__) == len(set(got[0].__fields__))
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    by = {r["doc_id"]: r for r in got}
    assert by[900]["predicted"] == by[901]["predicted"] == 0 and by[902]["predicted"] == 1 and by[None]["held_out"]
    assert by[902]["evidence"] and all(0 <= r["score"] <= 1 for r in got)


def test_no_labels(spark, frame):
    got = t.score(frame([(1, "a b")]), spark.createDataFrame([], LABELS)).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.0, 0)]
    assert t.score(frame([]), spark.createDataFrame([(1, 1, 1)], LABELS)).collect() == []


def test_nearest_is_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(3000):
        terms = np.unique(rng.integers(0, 60, rng.integers(1, 9)))
        vectors.append((terms, rng.integers(1, 4, len(terms))))
    idf = rng.random(60) + 1
    index = t.Examples(vectors, list(range(3000)), np.zeros(3000), np.ones(3000), idf)
    dense = np.zeros((3000, 60))
    for i, (terms, tf) in enumerate(vectors):
        dense[i, terms] = index.unit(terms, tf)
    for q in range(0, 3000, 50):
        cosines = dense @ dense[q]
        cosines[q] = -1
        found, got = index.nearest(*vectors[q], 25, leave=q)
        want = np.lexsort((np.arange(3000), -np.round(cosines, 12)))[:25]
        assert np.allclose(got, cosines[want]) and np.array_equal(found, want)
        some, near = index.nearest_of([vectors[q]], 25, [q])[0]
        assert np.allclose(np.sort(near), np.sort(cosines[want])) and set(some.tolist()) == set(want.tolist()) and np.array_equal(some[:3], want[:3])


def test_isotonic():
    x, y = t.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert list(y) == [0.0, 0.5, 1.0]


def test_every_text_has_neighbours(spark, frame):
    """Clean texts are examples and are searched too: no term needs to tell the classes apart."""
    rng = random.Random(11)
    words = [a + b + c for a in "klmnprst" for b in "aeiou" for c in "klmnprst"]
    rows = [(i, " ".join(rng.sample(words, 8))) for i in range(300)]
    rows.append((1000, rows[0][1]))
    labels = [(i, 0, int(i % 10 == 0)) for i in range(300)]
    got = t.score(frame(rows), spark.createDataFrame(labels, LABELS), folds=1000, held=1000).collect()
    assert all(r["evidence"] for r in got)
    copy = next(r for r in got if r["doc_id"] == 1000)
    assert copy["evidence"][0]["doc_id"] == 0 and abs(copy["evidence"][0]["cosine"] - 1) < 1e-9
    assert {e["toxic"] for r in got for e in r["evidence"]} == {0, 1}
