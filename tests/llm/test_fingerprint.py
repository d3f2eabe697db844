import hashlib
import re

from locusframe.llm import fingerprint as f


def test_fingerprints(frame):
    text = "First one here. Second! Third?\nA new paragraph, " + "long " * 40 + "\n\nEnd."
    rows = [(1, text), (2, text.replace("Second", "Changed")), (3, None), (4, ""), (5, "x"), (7, text), (7, "b text. tie"), (None, "last in order. é"), (9, "word " * 30_000)]
    got = f.fingerprints(frame(rows)).collect()
    order = sorted(((-(1 << 63) if i is None else i, t or "") for i, t in rows), key=lambda r: (-r[0], r[1]))
    assert len(got) == len(rows)
    by = {(-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["text"]): r for r in got}
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        h = len(t) // 2
        r = by[i, t]
        assert r["edited_text"] == t[: len(t) - h] + after[:h] and r["n_chars"] == len(t)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by[1, text]["fingerprint"] == by[7, text]["fingerprint"] != by[2, text.replace("Second", "Changed")]["fingerprint"]
    assert by[2, text.replace("Second", "Changed")]["near_next"] > 0.6
    assert by[3, ""]["fingerprint"] == by[4, ""]["fingerprint"] and by[4, ""]["near_next"] == 1
    assert len({r["fingerprint"] for r in got}) == len({r["text"] for r in got})


def test_tree(frame):
    r = f.fingerprints(frame([(1, "A b.\nC d.")])).first()
    leaf = [hashlib.sha256(x.encode()).hexdigest() for x in ("A b.", "C d.")]
    para = [hashlib.sha256(x.encode()).hexdigest() for x in leaf]
    named = re.findall(r"([0-9a-f]{8}):([0-9a-f.]+)", r["fingerprint"])
    assert named == [(p[:8], x[:8]) for p, x in zip(para, leaf, strict=True)]
    assert r["edited_text"] == "A b.\nA b."


def test_many_lines(frame):
    """Long runs of blank or equal lines: the tree is as by hand, and blank lines count in the likeness."""
    texts = ["\n" * 500, "\n" * 1_000_000, "same line\n" * 1_000_000, "a.\n" * 3 + "\n" * 5000 + "z"]
    got = {r["doc_id"]: r for r in f.fingerprints(frame(list(enumerate(texts)))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for i, text in enumerate(texts):
        own = [sha(sha(p)) for p in text.split("\n")] if len(text) < 20_000 else []
        sections, at = [], []
        for p, d in enumerate(own):
            at.append(d)
            if d[0] in "01" or p + 1 == len(own):
                sections.append(sha("".join(at)))
                at = []
        if own:
            assert got[i]["fingerprint"].split("=")[0] == sha("".join(sections))
        assert len(got[i]["fingerprint"]) > 64 and got[i]["n_chars"] == len(text)
    assert 0 < got[0]["near_edited"] < 1 and 0 < got[3]["near_edited"] < 1


def test_least_id_and_null(frame):
    """A null id comes after the least one."""
    got = f.fingerprints(frame([(None, "null"), (-(1 << 63), "least"), (4, "four")])).collect()
    assert {r["text"]: r["edited_text"] for r in got} == {"four": "fole", "least": "leanu", "null": "nufo"}


def test_empty(frame):
    assert f.fingerprints(frame([])).collect() == []
