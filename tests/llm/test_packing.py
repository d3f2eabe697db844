import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from locusframe.llm import packing, queries

SCHEMA = "doc_id long, text string, lang string, offset long"
PATH = queries.tokenizer_path("word_bpe_49k.json")


def check(rows, docs, window):
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text, *_ in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(bytes(r.ids)) == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_seq


def test_pack_round_trip(spark):
    words = "the of and Thntblere étion ßö 12 x's don't 日本 a-b, c. <|endoftext|> é".split()
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 400))), "en", 7) for i in range(60)]
    docs += [(100, None, None, None), (101, "", "en", 1), (102, "word " * 3000, "en", 1)]
    rows = packing.pack(spark.createDataFrame(docs, SCHEMA), PATH, window=256).collect()
    by_seq = check(rows, docs, 256)
    used = sum(r.length for r in rows)
    padded = sum(0 if (n := sum(r.length for r in p)) & (n - 1) == 0 else 256 - n for p in by_seq.values())
    assert padded <= 256 * 4 and used > 10_000


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_place_minimises_squares():
    rng = np.random.default_rng(2)
    packer, levels = packing.LevelPacker(32), np.zeros(33, int)
    for size in rng.integers(1, 32, 400).tolist():
        best = min(
            sum((levels[h] - (h == a) + (h == a + size)) ** 2 for h in range(1, 32))
            for a in range(0, 33 - size) if a == 0 or levels[a]
        )
        packer.place(size, (0, 0, size))
        levels = np.append(packer.twice[:32] // 2, 0)
        levels[0] = 0
        assert (levels[1:32] ** 2).sum() == best


@pytest.mark.parametrize("seed", range(3))
def test_drain_keeps_all(seed):
    rng = np.random.default_rng(seed)
    packer, total, out = packing.LevelPacker(64), 0, []
    for key, size in enumerate(rng.integers(1, 64, 50).tolist()):
        total += size
        done = packer.place(size, (key, 0, size))
        if done:
            out.append(done)
    out += list(packer.drain())
    sums = [sum(x[2] for x in w) for w in out]
    assert sum(sums) == total and sum(1 for s in sums if s & (s - 1)) <= 1
