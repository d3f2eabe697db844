import random

import pytest

from locusframe.llm import decontaminate as d


def brute(rows, items, least=1):
    def sh(t, m=5):
        w = (t or "").lower().split()
        return {tuple(w[k : k + m]) for k in range(len(w) - m + 1)}

    out = {}
    for i, t, *_ in rows:
        for j, x in items:
            m = min(len((x or "").split()), 5)
            if m < least:
                continue
            n, k = len(sh(x, m)), len(sh(x, m) & sh(t, m))
            if n and 100 * k >= 75 * n:
                out[i, j] = max(out.get((i, j), (0, 0)), (k, n))
    return out


@pytest.mark.parametrize("limit", [1000, 0])
def test_same_as_brute_force(spark, frame, monkeypatch, limit):
    monkeypatch.setattr(d, "BROADCAST_SKETCH", limit)
    monkeypatch.setattr(d, "BROADCAST_PAIRS", limit)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(200)}"
    items = [(j, " ".join(word() for _ in range(n))) for j, n in enumerate((5, 6, 9, 20, 40, 64, 4, 30, 1, 2, 3))] + [(50, None), (51, ""), (52, " ".join(["a"] * 30)), (53, " ".join(["a"] * 30)), (None, "n1 n2 n3 n4 n5 n6")]
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(20)]
    for i, (_, x) in enumerate(items):
        w = (x or "").split()
        for k, changed in enumerate((0, 1, 3)):
            own = list(w)
            for _ in range(min(changed, len(own))):
                own[rng.randrange(len(own))] = "zz"
            rows.append((100 + 10 * i + k, f"{word()} {' '.join(own).upper()}\n{word()}" + " tail" * (20_000 if k == 0 and i == 4 else 3)))
    rows += [(900, None), (901, ""), (None, items[3][1]), (100, rows[-1][1]), (100, rows[-1][1])]
    got = d.matches(frame(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in got.collect()} == brute(rows, items)
    kept = d.drop_contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame(rows).columns
    bad = brute([(k, t) for k, (_, t) in enumerate(rows)], items, 5)
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(str(r[:2]) for k, r in enumerate(rows) if not any(a == k for a, _ in bad))


def test_empty(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.matches(frame([]), none).collect() == []
    assert d.drop_contaminated(frame([(1, "a b c d e f")]), none).count() == 1


def test_short_items_alone(spark, frame):
    """Items of one to four words by their whole sequence, never across another word; the query's SQL agrees."""
    import duckdb

    items = [(1, "Alpha"), (2, "beta gamma"), (3, "a b c d"), (4, "a b c"), (5, "a b c d"), (6, " "), (7, None)]
    rows = [(1, "alpha"), (2, "alphabet beta\tGAMMA"), (3, "beta x gamma"), (4, "x a b c d a b"), (5, "a b"), (6, None), (7, ""), (8, "a b " * 300 + "c")]
    got = {tuple(r) for r in d.matches(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {r[:2]: r[2:4] for r in got} == brute(rows, items)
    assert {r[:2] for r in got} == {(1, 1), (2, 2), (4, 3), (4, 4), (4, 5), (8, 4)}
    db = duckdb.connect()
    for name, key, table in (("documents", "doc_id", rows), ("benchmark", "item_id", items)):
        db.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", table)
    assert set(db.execute(d.ORACLE).fetchall()) == got
    assert d.drop_contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string")).count() == len(rows)
    assert d.drop_contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string"), least_words=3).count() == len(rows) - 2
