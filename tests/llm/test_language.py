import itertools
import random

import numpy as np
import pytest

from locusframe.llm import languageid as g
from locusframe.llm import queries

PATH = queries.tokenizer_path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    data = sorted([bytes([g.MARK]) + b"a", b"a", b"b", b"ab", b"ba", b"bab"])
    pieces = g.Pieces(data)
    theta = np.random.default_rng(1).random((len(data), 2))
    of = {p: theta[i] for i, p in enumerate(data)}
    for word in (b"a", b"abab", b"bb", b"babba", b"axb"):
        full = bytes([g.MARK]) + word
        total = np.zeros(2)
        for cuts in itertools.product((0, 1), repeat=len(full) - 1):
            parts, at = [], 0
            for k, c in enumerate(cuts, 1):
                if c:
                    parts.append(full[at:k])
                    at = k
            parts.append(full[at:])
            p = np.ones(2)
            for x in parts:
                p = p * (np.maximum(of.get(x, np.zeros(2)), g.UNKNOWN) if len(x) == 1 else of.get(x, np.zeros(2)))
            total += p
        rows = np.frombuffer(full, np.uint8)[None]
        assert g.forward(rows, pieces, g._table(theta))[0] == pytest.approx(total)


def test_expected_counts():
    data = [b"a", b"ab", b"b"]
    pieces, theta = g.Pieces(data), np.array([0.2, 0.5, 0.3])
    got = g.expected(np.frombuffer(b"ab", np.uint8)[None], np.array([2.0]), pieces, theta)
    both = 0.2 * 0.3
    assert got == pytest.approx([2 * both / (both + 0.5), 2 * 0.5 / (both + 0.5), 2 * both / (both + 0.5)])


def test_long_words():
    """Parts and scaled sums equal the plain forward sums; expected counts too; no underflow."""
    rng = np.random.default_rng(4)
    data = sorted([bytes([g.MARK]) + b"a", b"a", b"b", b"ab", b"ba", b"bab", b"abbaabbaabba", "日本".encode(), "語".encode()])
    pieces = g.Pieces(data)
    theta = rng.random((len(data), 2)) / 4
    table = g._table(theta)
    for word in (b"ab" * 9, b"aabbab", b"axxb" * 5, "日本語日".encode() * 2, b"abbaabbaabbaabba"):
        full = np.frombuffer(bytes([g.MARK]) + word, np.uint8)
        plain = np.log(g.forward(full[None], pieces, table))[0]
        assert g.log_forward_long(full, pieces, table) == pytest.approx(plain)
        parts = g.parted(full, pieces)
        assert b"".join(p.tobytes() for p in parts) == full.tobytes()
        assert sum(np.log(g.forward(p[None], pieces, table))[0] for p in parts) == pytest.approx(plain)
        want = g.expected(full[None], np.array([3.0]), pieces, theta[:, 0])
        assert g.expected_long(full, 3.0, pieces, theta[:, 0]) == pytest.approx(want)
        assert sum(g.expected_long(p, 3.0, pieces, theta[:, 0]) for p in parts) == pytest.approx(want)
    long = "\U00013080".encode() * 10_000 + b"ab" * 5000
    got = g.log_words(np.frombuffer(long, np.uint8), np.array([0]), np.array([len(long)]), pieces, table)
    assert np.isfinite(got).all() and (got < 0).all()


def test_identify(frame):
    rng = random.Random(2)
    words = {"en": "the of and house water stone with under".split(), "de": "der und nicht schön über zwischen haus".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(12)), lang) for i in range(120) for lang in [("en", "de")[i % 2]]]
    odd = [(500, None, "en"), (501, "", None), (502, "12 — 34 …", "de"), (None, "the house", "en"), (503, "ÜBER SCHÖN Haus " * 9000, None), (504, "x" * 5000, None), (505, "日本", None), (506, "\U00013080" * 10, None), (507, "\U00013080" * 10_000, None), (508, "ab" * 4000 + " the house", "en"), (0, rows[0][1], "en")]
    got = g.identify(frame(rows + odd), PATH).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(odd)
    assert all(by[i]["lang_pred"] == lang for i, _, lang in rows)
    assert [by[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3 and by[503]["lang_pred"] == "de" and by[None]["held_out"]
    assert by[508]["lang_pred"] == "en" and {by[506]["lang_pred"], by[507]["lang_pred"]} <= set(words)
    assert by[505]["lang_pred"] in words and all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn(frame):
    assert [r["lang_pred"] for r in g.identify(frame([(1, "words here", None)]), PATH).collect()] == ["und"]
    assert g.identify(frame([]), PATH).collect() == []
