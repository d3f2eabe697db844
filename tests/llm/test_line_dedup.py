from collections import Counter, defaultdict

from locusframe.llm import linededup


def brute(rows, ratio, least):
    pages, lines = Counter(), defaultdict(Counter)
    for _, text, _, host in rows:
        pages[host] += 1
        lines[host].update({x for x in text.split("\n") if x.strip(" ")} if text is not None else ())
    drop = {h: {x for x, k in c.items() if k >= least and k > ratio * pages[h]} for h, c in lines.items()}
    return Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if x not in drop[h] or not x.strip(" "))) for i, t, _, h in rows)


def test_boilerplate(frame, monkeypatch):
    rows = [(i, f"menu\n\nown {i}\nmenu\nfoot {i % 2}", None, "a") for i in range(20)] + [(100 + i, "menu\nx", None, "b") for i in range(3)]
    rows += [(200 + i, "nullhost\ny", None, None) for i in range(6)] + [(300, None, None, "a"), (301, "", None, "a"), (5, rows[5][1], None, "a"), (None, "menu\nz", None, "a"), (400, "w " * 50_000 + "\nmenu", None, "a")]
    for limit in (linededup.BROADCAST_LINES, 0):
        monkeypatch.setattr(linededup, "BROADCAST_LINES", limit)
        got = linededup.drop_boilerplate(frame(rows), ratio=0.3, min_pages=5)
        assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == brute(rows, 0.3, 5)
        assert got.columns.count("n_lines") == 1
    r = got.where("doc_id = 1").first()
    assert (r["n_lines"], r["n_dropped"]) == (5, 3) and r["hash"] == "x"


def test_empty(frame):
    assert linededup.drop_boilerplate(frame([])).collect() == []
