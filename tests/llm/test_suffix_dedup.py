import random

import numpy as np
import pytest

from locusframe.llm import suffixdedup as s


def brute(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    seen, out = set(), [None] * len(rows)
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for a in range(len(data) - 99):
            part = data[a : a + 100]
            if part in seen:
                gone[a : a + 100] = True
            seen.add(part)
        runs = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1)
        out[i] = (rows[i][0], len(data), int(gone.sum()), len(runs), bytes(np.frombuffer(data, np.uint8)[~gone]))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_brute_force(frame, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [text(n) for n in (99, 100, 101, 150, 400)]
    rows = []
    for i in range(40):
        rows.append((rng.randrange(10**6) * 100 + i, "".join(rng.choice((text(rng.randrange(120)), rng.choice(shared), rng.choice(shared)[5:], rng.choice(shared)[:-7])) for _ in range(rng.randrange(6)))))
    rows += [(1, "a" * 99), (2, "a" * 100), (3, "a" * 101), (4, "ab" * 300), (5, "abc" * 40 + "x"), (6, None), (7, ""), (None, shared[4]), (8, text(30_000) + shared[3])]
    got = s.remove_repeats(frame(rows), hot=(2000, 3, 1)[seed - 1], slice_bytes=500).collect()
    assert sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"]))) for r in got) == brute(rows)


def test_repeated_rows(frame):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdef") for _ in range(300))
    got = sorted((r["n_removed"], len(r["kept"])) for r in s.remove_repeats(frame([(1, t), (1, t), (1, "short"), (1, "short")])).collect())
    assert got == [(0, 5), (0, 5), (0, 300), (300, 0)]
    # A repeated row that shares part of a passage with another document.
    shared = t[:150]
    rows = [(1, shared + "x" * 120), (2, "y" * 60 + shared), (2, "y" * 60 + shared), ((1 << 63) - 1, "z" * 70 + shared)]
    got = {(r["doc_id"], r["n_removed"]) for r in s.remove_repeats(frame(rows)).collect()}
    assert got == {(1, 119), (2, 150), (2, 210), ((1 << 63) - 1, 150)}


def test_suffix_ranks():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    data = text.tobytes()
    full = s.suffix_ranks(text)
    assert sorted(range(400), key=lambda i: data[i:]) == np.argsort(full).tolist()
    rank = s.suffix_ranks(text, 64)
    for i, j in rng.integers(0, 330, (500, 2)).tolist():
        a, b = data[i : i + 64], data[j : j + 64]
        assert int(rank[i] > rank[j]) - int(rank[i] < rank[j]) == (a > b) - (a < b)


def test_common_prefixes():
    """Kasai in lanes against plain comparing, with runs longer than a lane."""
    rng = np.random.default_rng(2)
    for text in (rng.integers(97, 99, 500), np.full(300, 97), np.tile(rng.integers(97, 100, 70), 6), rng.integers(97, 99, 3)):
        text = text.astype(np.uint8)
        order = np.argsort(s.suffix_ranks(text), kind="stable")
        got = s.common_prefixes(text, order)
        data = text.tobytes()
        for k in range(1, len(order)):
            a, b = data[order[k - 1] :], data[order[k] :]
            n = next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))
            assert got[k] == min(n, 100)


def test_hot_line_is_sent_once(frame):
    """A passage of every text: a task sends each of its stretches once, and the result is as by brute force."""
    import pyarrow as pa

    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcde ") for _ in range(n))
    hot = text(300)
    rows = [(i, text(130) + hot + text(130)) for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array(range(200)), pa.array([t for _, t in rows])], names=["key", "th", "text"])
    (dealt,) = s._deal(1)(iter([batch]))
    sent = [r for r in dealt.to_pylist() if r["doc"]]
    found = [r for r in dealt.to_pylist() if not r["doc"]]
    lone = s.stretches(np.frombuffer(hot.encode(), np.uint8), np.array([0, 300]))[0]
    assert sum(len(r["again"]) for r in sent) < 200 * 18 and len(found) == 1 and len(found[0]["at"]) // 4 == 199 and len(lone) > 5
    got = s.remove_repeats(frame(rows)).collect()
    assert sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"]))) for r in got) == brute(rows)


def test_empty(frame):
    assert s.remove_repeats(frame([])).collect() == []
