import random
import re
import time

from locusframe.llm import secretscan as s

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)


def brute(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return [(s.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_base_and_formats(frame):
    rng = random.Random(3)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'é some words token = "{hexed(40)}" and more') for i in range(60)]
    rows += [(100 + i, f"number {rng.randrange(10**15, 10**16)} and address a-{i}.b@mail{i}.example.com/abcdefgh") for i in range(60)]
    rows += [(200, None), (201, ""), (202, "token:token:abcdefgh PASSWORD= 'abc' Api_Key:abcdef apikey=a"), (203, "AKIA" + "A1" * 8 + " AKIASHORT"), (204, "f" * 23 + " " + "0" * 24 + "é" + "a" * 5000), (205, "K ſecret=abcdefgh"), (206, f"x {hexed(40)[:22]} y"), *[(300 + i, f"é ACCESS={hexed(22)}. end") for i in range(10)], (None, "secret=abcdef"), (0, rows[0][1]), (0, rows[0][1])]
    got = s.scan(frame(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), str(brute(t or ""))) for i, t in rows)
    assert sorted((str(r["doc_id"]), str([(x["kind"], x["start"], x["end"]) for x in r["spans"] if x["kind"] != "format"])) for r in got) == want
    assert all(x["value"][:7] != "ACCESS=" and x["value"][-1] != "." for r in got for x in r["spans"] if x["kind"] == "format" and 300 <= (r["doc_id"] or 0))
    formats = {r["doc_id"] for r in got if any(x["kind"] == "format" for x in r["spans"])}
    assert 206 in formats and sum(300 + i in formats for i in range(10)) >= 8 and not any(i is not None and 100 <= i < 200 for i in formats)


def test_candidates():
    """Against all pairs: runs that meet no base match; and in time that grows with the text."""
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(("token=abcdefgh", "a1b2c3d4" * 4, " ", "é", "secret: zz", "-", "plainword", "0f" * 13)) for _ in range(12))
        base = s.base_spans(text)
        runs = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_.=-]{6,}", text)]
        assert list(s.candidates(runs, base)) == [(a, b) for a, b in runs if not any(x < b and y > a for x, _, y in base)]
    text = "token=abcdefgh word1234567 " * 200_000
    base = s.base_spans(text)
    assert len(list(s.candidates([m.span() for m in re.finditer(r"[A-Za-z0-9+/_.=-]{6,}", text)], base))) == 200_000


def test_readings():
    run = "NAME=abc=12345678.="
    got = {run[a:b] for a, b in s.readings(run, 6)}
    assert {run, "abc=12345678.=", "12345678.=", "12345678", "NAME=abc=12345678"} <= got and all(len(x) >= 6 for x in got)


def some_formats():
    rng = random.Random(9)
    kinds = {"assign": [rng.choice(("k-", "key")) + "".join(rng.choice("0123456789ABCDEF") for _ in range(rng.randint(8, 20))) for _ in range(120)], "hex": ["".join(rng.choice("0123456789abcdef") for _ in range(24)) for _ in range(80)]}
    return s.Formats(kinds, ["".join(rng.choice("abcdefghij-/=._") for _ in range(rng.randint(6, 30))) for _ in range(200)]), kinds


def test_many_starts():
    """Scored together, a run has the reading and the gain of one by one, to the last bit."""
    formats, kinds = some_formats()
    rng, found = random.Random(10), 0
    for _ in range(150):
        run = "=".join(rng.choice(("x", "", "name", rng.choice(kinds["assign"]), rng.choice(kinds["hex"]))) for _ in range(rng.randint(1, 9))) + rng.choice(("", ".", "=.", "-"))
        want = None
        for a, b in s.readings(run, formats.least):
            gain = formats.score(run[a:b])
            if gain is not None and (want is None or gain > want[2]):
                want = (a, b, gain)
        assert formats._best_of_many(run, *s.borders(run)) == formats.best(run) == want
        found += want is not None
    assert 30 < found < 150


def test_long_run_is_linear():
    formats, kinds = some_formats()
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        run = "a1=" * n + kinds["hex"][0]
        assert formats.best(run)[:2] == (3 * n, len(run))
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 1 and took[1] < 40


def test_automaton():
    rng = random.Random(1)
    a = s.Automaton(["id-" + "".join(rng.choice("01") for _ in range(8)) for _ in range(100)])
    assert len(a.states) < 60 and a.per_char("id-01010101") > a.per_char("xy-01010101") > a.per_char("zzzzzzzzzzz")


def test_empty(frame):
    assert s.scan(frame([])).collect() == []
