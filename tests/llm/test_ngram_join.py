import random
import re

import pytest

from locusframe.llm import graph, ngramjoin

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(str((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc)) for i, (doc, *_) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(frame, seed):
    rng = random.Random(seed)
    rows, doc = [], 1000
    for _ in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice((5, 8, 30, 90, 200)))]
        for _ in range(rng.choice((1, 2, 9))):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, len(own) // 12))):
                own[rng.randrange(len(own))] = f"n{rng.randrange(9)}"
            if rng.random() < 0.3:
                own += ["extra"] * rng.randrange(len(own) // 2)
            doc -= 1
            rows.append((doc, rng.choice((" ", "\n", "\x0b")).join(own).replace("w1", "W1")))
    rows += [(2, None), (3, ""), (4, " \n "), (5, "one two"), (6, "One  TWO"), (7, "É é a b"), (8, "é é a b"), (None, rows[0][1]), (None, "alone in null"), (rows[1][0], rows[1][1]), (-(1 << 63), "least id alone here"), ((1 << 63) - 1, rows[0][1]), (9, "same " * 3000), (10, "same " * 7)]
    got = ngramjoin.join_components(frame(rows))
    assert sorted(str(tuple(r)) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)


def test_chain_beyond_the_threshold(frame):
    words = [f"w{k}" for k in range(200)]
    rows = [(10 - i, " ".join([*words[i * 9 : i * 9 + 100]])) for i in range(8)]
    got = ngramjoin.join_components(frame(rows))
    assert {r["component_id"] for r in got.collect()} == {3}
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def edited(n, seed=5):
    rng, base = random.Random(seed), [f"w{k}" for k in range(60)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(2):
            own[rng.randrange(60)] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(own)))
    return rows


def test_answers_grow_with_the_group(frame, monkeypatch):
    """Of a group of near copies, each set is verified against a few others, not against all."""
    counts, verified = [], ngramjoin.verified

    def counted(pairs, sets, name):
        counts[-1] += (found := verified(pairs, sets, name)).count()
        return found

    monkeypatch.setattr(ngramjoin, "verified", counted)
    for n in (300, 600):
        counts.append(0)
        rows = edited(n)
        got = ngramjoin.join_components(frame(rows))
        assert sorted(str(tuple(r)) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)
    assert counts[0] <= 300 and counts[1] <= 600


def test_hot_head(frame):
    """A group around one text: links come from it, few other pairs are opened."""
    rng, base = random.Random(3), [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        own = list(base)
        for _ in range(rng.randrange(1, 12)):
            own[rng.randrange(150)] = f"n{rng.randrange(400)}"
        rows.append((i, " ".join(own)))
    got = ngramjoin.join_components(frame(rows))
    assert sorted(str(tuple(r)) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)


def test_empty(frame):
    assert ngramjoin.join_components(frame([])).collect() == []


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (103, 102), (101, 102), (7, 7)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)}
