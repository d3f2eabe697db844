"""Operator 4: toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Terms are words (letter runs, lower case) and their beginnings of 4 and 6 bytes. A bounded
sample of labelled rows (at most about ``SAMPLE`` of a class, by a hash of the id) are the
examples: unit vectors of (1 + ln tf) * idf over all their terms, whose document
frequencies are counted over all rows. Terms of a text that no example holds are left out
of its vector: they lengthen it, but its nearest examples and votes are the same.

The index keeps, for each term, its examples' weights and, for terms of many examples, the
greatest weight of every block of ``BLOCK`` like examples. A block's bound is the part of
the cosines by rarer terms plus the text's weights times those maxima, or times the length
of the block's longest example if that is less; blocks whose bound is below the K-th
neighbour stay closed. Cosines that single precision can't tell apart are made again in
double, so the K nearest are exact. Their votes count by the square of their cosine and by
their class's sampling rate. Votes become probabilities by the isotonic fit of the sample's
own leave-one-out votes (of about ``CALIBRATION`` examples), and K is the one of ``KS``
whose fit has the least squared error there; a text without a term gets the
rate of such texts in the sample, or of all labelled rows if the sample has fewer than K.
The three nearest examples are the evidence.

Nulls and empty texts: no term, so the rate for such. Labels that are null, and rows
whose id is null, are never learned from (a null id counts as held out). Several labels of
an id: toxic if any is. Without labels all scores are 0. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE_VALUES, LETTER, U64, broadcast_if_small, chunks, distinct, lowered, mix, prefix_hashes, ragged, released, span_hashes, spans_of, text_buffer

SAMPLE = 8000
BEGINNINGS = (4, 6)
KS = (25, 50, 100)
CALIBRATION = 4000
#: Nearest examples whose order is exact too; they are the evidence.
EVIDENCE = 3
BLOCK = 128
FIRST_BLOCKS = 8
FREQUENT = 1 / 16
GROUP = 256
GROUPS = 64
ROUNDS = 6
#: More than the rounding of single precision; what is that near the K-th is compared in double.
SLACK = np.float32(1e-5)


def text_terms(raw: np.ndarray, offsets: np.ndarray, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of a chunk, sorted by row; of the sorted ``chosen`` term hashes their numbers, else hashes."""
    low = lowered(raw)
    s, e = spans_of(LETTER[low], offsets)
    none = np.zeros(0, np.int64)
    if not len(s):
        return none, none.astype(U64), none
    row = np.searchsorted(offsets, s, "right") - 1
    prefix = prefix_hashes(BYTE_VALUES[low])
    keys, index, inverse = distinct(span_hashes(prefix, s, e))
    ws, we = s[index], e[index]
    word, term = [np.arange(len(keys))], [keys]
    for n in BEGINNINGS:
        long = np.flatnonzero(we - ws > n)
        word.append(long)
        term.append(mix(span_hashes(prefix, ws[long], ws[long] + n) + U64(n)))
    word, term = np.concatenate(word), np.concatenate(term)
    if chosen is not None:
        at = np.minimum(np.searchsorted(chosen, term), max(len(chosen) - 1, 0))
        hit = chosen[at] == term if len(chosen) else np.zeros(len(term), bool)
        word, term = word[hit], at[hit].astype(U64)
    if not len(word):
        return none, none.astype(U64), none
    # Words' occurrences by row, then every term of the word; counted as sorted (row, term) codes.
    order = np.argsort(word, kind="stable")
    word, term = word[order], term[order]
    names, _, number = (None, None, term.astype(np.int64)) if chosen is not None else distinct(term)
    width = len(chosen) if chosen is not None else len(names)
    first, n = np.searchsorted(word, np.arange(len(keys))), np.bincount(word, minlength=len(keys))
    many = n[inverse]
    code = np.repeat(row * width, many) + number[ragged(first[inverse], many)]
    code.sort()
    cut = np.flatnonzero(np.concatenate([np.ones(min(len(code), 1), bool), code[1:] != code[:-1]]))
    rows, terms = np.divmod(code[cut], width)
    return rows, names[terms] if names is not None else terms.astype(U64), np.diff(np.append(cut, len(code)))


def _each_chunk(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column(text_at))
        for a, b in chunks(offsets):
            yield batch, a, b, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, _, raw, offsets in _each_chunk(batches, 0):
        yield pa.RecordBatch.from_arrays([pa.array(distinct(text_terms(raw, offsets)[1])[0].astype(np.int64))], names=["term"])


def _vectors(shared: Broadcast):
    """(id, toxic, terms' numbers, tf) of the examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, raw, offsets in _each_chunk(batches, 2):
            rows, terms, tf = text_terms(raw, offsets, shared.value)
            cuts = np.searchsorted(rows, np.arange(b - a + 1))
            packed = [(terms[i:j].astype(np.int32).tobytes(), zlib.compress(tf[i:j].astype(np.int32).tobytes(), 1)) for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(c, pa.binary()) for c in zip(*packed, strict=True)]], names=["id", "toxic", "terms", "tf"])

    return run


def _frequencies(shared: Broadcast):
    """(term, n): texts with each of the shared terms; their number is the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        counts = np.zeros(len(chosen) + 1, np.int64)
        for _, a, b, raw, offsets in _each_chunk(batches, 0):
            counts[-1] += b - a
            counts[:-1] += np.bincount(text_terms(raw, offsets, chosen)[1].astype(np.int64), minlength=len(chosen))
        found = np.flatnonzero(counts)
        for k in range(0, len(found), 1 << 16):
            part = found[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["term", "n"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of longs as a byte string a batch each."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(c).tobytes()], pa.binary()) for c in batch.columns], names=batch.schema.names)


def alike(columns: np.ndarray) -> np.ndarray:
    """A group's number for each column, by a few rounds of spherical k-means; fixed seeds."""
    n = columns.shape[1]
    centres = columns[:, np.linspace(0, n - 1, min(GROUPS, n)).astype(int)] if n else columns
    group = np.zeros(n, np.int64)
    for _ in range(ROUNDS if n else 0):
        group = np.argmax(centres.T @ columns, 0)
        sums = columns @ (group[:, None] == np.arange(centres.shape[1])).astype(np.float32)
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(0)), 1e-9)
    return group


class Examples:
    """Unit vectors of labelled texts in a block-max inverted index.

    Terms of at least ``FREQUENT`` of the examples are rows of a dense matrix, multiplied
    block by block; the others are postings, added up for all examples.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list[int], toxic: np.ndarray, rate: np.ndarray, idf: np.ndarray) -> None:
        terms = np.concatenate([t for t, _ in vectors]).astype(np.int32) if vectors else np.zeros(0, np.int32)
        tf = np.concatenate([f for _, f in vectors]).astype(np.int32) if vectors else np.zeros(0, np.int32)
        self._build(terms, tf, np.array([len(t) for t, _ in vectors], np.int64), ids, toxic, rate, idf)

    @classmethod
    def of(cls, *parts) -> Examples:
        self = cls.__new__(cls)
        self._build(*parts)
        return self

    def _build(self, terms: np.ndarray, tf: np.ndarray, many: np.ndarray, ids: list[int], toxic: np.ndarray, rate: np.ndarray, idf: np.ndarray) -> None:
        self.idf, self.ids, self.toxic, self.rate = idf, ids, toxic, rate
        self.term, self.n = terms, len(many)
        self.tf = tf.astype(np.uint16) if not len(tf) or tf.max() < 1 << 16 else tf
        self.start = np.concatenate([[0], np.cumsum(many)])
        count = np.bincount(terms, minlength=len(idf))
        self.blocks = max(-(-self.n // BLOCK), 1)
        frequent = np.flatnonzero(count >= max(FREQUENT * self.n, 1))
        self.slot = np.full(len(idf), -1, np.int32)
        self.slot[frequent] = np.arange(len(frequent))
        self.begin = np.concatenate([[0], np.cumsum(np.where(self.slot < 0, count, 0))])
        self.dense = np.zeros((len(frequent), self.blocks * BLOCK), np.float32)
        # A posting is a long: the example's place above its weight's bits, so that a list is copied at once.
        self.posting = np.zeros(self.begin[-1], np.int64)
        self.norm = np.ones(self.n)
        texts: dict[bytes, int] = {}
        self.twin = np.array([texts.setdefault(hashlib.blake2b(terms[a:b].tobytes() + tf[a:b].tobytes(), digest_size=16).digest(), i) for i, (a, b) in enumerate(zip(self.start[:-1].tolist(), self.start[1:].tolist(), strict=True))], np.int64)
        free = self.begin[:-1].copy()
        # A few examples at a time, so that little more memory than the index's own is taken.
        for a in range(0, self.n, BLOCK):
            b = min(a + BLOCK, self.n)
            part = slice(self.start[a], self.start[b])
            example, term = np.repeat(np.arange(a, b), many[a:b]), terms[part]
            own = (1 + np.log(tf[part])) * idf[term]
            self.norm[a:b] = np.sqrt(np.bincount(example - a, own * own, b - a))
            own /= self.norm[example]
            at = self.slot[term] >= 0
            self.dense[self.slot[term[at]], example[at]] = own[at]
            order = np.flatnonzero(~at)[np.argsort(term[~at], kind="stable")]
            names, first, times = np.unique(term[order], return_index=True, return_counts=True)
            to = np.repeat(free[names] - first, times) + np.arange(len(order))
            self.posting[to] = example[order] << 32 | own[order].astype(np.float32).view(np.int32)
            free[names] += times
        # Like examples share a block, so that few blocks reach a text's K-th cosine.
        self.number = np.concatenate([np.argsort(alike(self.dense[:, : self.n]), kind="stable"), np.arange(self.n, self.blocks * BLOCK)])
        self.place = np.argsort(self.number).astype(np.int32)
        for k in range(0, len(self.dense), BLOCK):
            self.dense[k : k + BLOCK] = self.dense[k : k + BLOCK][:, self.number]
        for k in range(0, len(self.posting), 1 << 20):
            part = self.posting[k : k + (1 << 20)]
            part[:] = self.place[part >> 32].astype(np.int64) << 32 | part & 0xFFFFFFFF
        self.most = self.dense.reshape(len(frequent), self.blocks, BLOCK).max(2) if len(frequent) else np.zeros((0, self.blocks), np.float32)
        self.longest = np.sqrt(sum((np.einsum("ij,ij->j", part, part) for part in np.array_split(self.dense, 16)), np.zeros(self.blocks * BLOCK, np.float32)).reshape(self.blocks, BLOCK).max(1))

    def unit(self, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * self.idf[terms]
        return w / np.sqrt((w * w).sum())

    def nearest(self, terms: np.ndarray, tf: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples in order and their cosines, exactly; ties by the example's number."""
        return self.nearest_of([(terms, tf)], k, [leave], k)[0]

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None, ordered: int = EVIDENCE) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k nearest of several texts at once, the first ``ordered`` in exact order; ``leave`` is an example to leave out of each."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(texts), GROUP):
            out += self._group(texts[a : a + GROUP], k, [-1] * len(texts[a : a + GROUP]) if leave is None else leave[a : a + GROUP], ordered)
        return out

    def _group(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int], ordered: int) -> list[tuple[np.ndarray, np.ndarray]]:
        size, wide = len(texts), self.blocks * BLOCK
        q = [self.unit(t, tf) for t, tf in texts]
        dense = np.zeros((size, len(self.dense)), np.float32)
        cosine = np.empty((size, wide), np.float32)
        for i, (terms, _) in enumerate(texts):
            slot = self.slot[terms]
            dense[i, slot[slot >= 0]] = q[i][slot >= 0]
            rare = terms[slot < 0]
            lo, hi = self.begin[rare], self.begin[rare + 1]
            if len(rare):
                posting = np.concatenate([self.posting[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
                weight = np.repeat(q[i][slot < 0], hi - lo)
                weight *= posting.astype(np.int32).view(np.float32)
                posting >>= 32
                cosine[i] = np.bincount(posting, weight, wide)
            else:
                cosine[i] = 0
        # Blocks are opened for the texts whose bound there reaches the K-th cosine found so far.
        length = np.sqrt(np.einsum("ij,ij->i", dense, dense))[:, None]
        bounds = cosine.reshape(size, self.blocks, BLOCK).max(2) + np.minimum(dense @ self.most, length * self.longest) + SLACK
        few = min(FIRST_BLOCKS, self.blocks)
        begin = np.argpartition(-bounds, few - 1, 1)[:, :few]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, begin, True, 1)
        least = np.zeros(size, np.float32)
        for open_now in (first, ~first):
            open_now &= bounds >= least[:, None]
            for block in np.flatnonzero(open_now.any(0)).tolist():
                at, own = np.flatnonzero(open_now[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                if len(at) == size:
                    cosine[:, own] += dense @ self.dense[:, own]
                else:
                    cosine[at, own] += dense[at] @ self.dense[:, own]
            for i, x in enumerate(leave):
                if x >= 0:
                    cosine[i, self.place[x]] = 0
            if open_now is first and few * BLOCK > k:
                opened = np.take_along_axis(cosine.reshape(size, self.blocks, BLOCK), begin[:, :, None], 1).reshape(size, -1)
                least = np.partition(opened, few * BLOCK - k, 1)[:, few * BLOCK - k] - SLACK
        return [self._in_order(terms, q[i], cosine[i], least[i], k, ordered) for i, (terms, _) in enumerate(texts)]

    def _in_order(self, terms: np.ndarray, weights: np.ndarray, cosine: np.ndarray, least: np.float32, k: int, ordered: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of a text by its cosines in single precision; where these can't tell who is in, or the first ones' order, they are made again."""
        near = np.flatnonzero(cosine >= max(least, np.float32(1e-30)))
        if len(near) > k:
            own = cosine[near]
            near = near[own >= np.partition(own, len(near) - k)[len(near) - k] - SLACK]
        near = near[np.argsort(-cosine[near], kind="stable")]
        found, near = cosine[near].astype(float), self.number[near]
        unsure = np.arange(len(near)) < ordered
        if len(near) > ordered > 0:
            unsure |= np.abs(found - found[ordered - 1]) <= SLACK
        if len(near) > k:
            unsure |= np.abs(found - found[k - 1]) <= SLACK
        again = np.flatnonzero(unsure)
        if len(again):
            # Examples of one text have one cosine; the text's terms are looked up in theirs, both sorted.
            kinds = self.twin[near[again]].tolist()
            own, part = terms.astype(np.int32), weights * self.idf[terms]
            exact = {kind: self._cosine(own, part, kind) for kind in set(kinds)}
            found[again] = [exact[kind] for kind in kinds]
        top = np.lexsort((near, -np.round(found, 12)))[:k]
        return near[top], found[top]

    def _cosine(self, terms: np.ndarray, weights: np.ndarray, i: int) -> float:
        a, b = self.start[i], self.start[i + 1]
        at = np.searchsorted(self.term[a:b], terms)
        at[at == b - a] = 0
        met = np.flatnonzero(self.term[a + at] == terms)
        return float((weights[met] * (1 + np.log(self.tf[a + at[met]].astype(float)))).sum() / self.norm[i])

    def text(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.start[i], self.start[i + 1])
        return self.term[own], self.tf[own]

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        w = cosines**2 * self.rate[found]
        return float((w * self.toxic[found]).sum() / w.sum()) if w.sum() > 0 else -1.0


class Sample:
    """What the examples are made of; it is unpickled as their index, so that only workers build that."""

    def __init__(self, *parts) -> None:
        self.parts = parts

    def __reduce__(self) -> tuple:
        return Examples.of, self.parts


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y by x: points to interpolate."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        pools.append([xi * wi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


class Model:
    """The examples' terms, the examples, the isotonic points, the score of a text without terms, and K."""

    def __init__(self, chosen: Broadcast | None, examples: Broadcast | None, points: tuple[np.ndarray, np.ndarray], bare: float, k: int = KS[0]) -> None:
        self.chosen, self.examples, self.points, self.bare, self.k = chosen, examples, points, bare, k

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        e, out = self.examples.value if self.examples else None, [(self.bare, [])] * len(texts)
        known = [i for i, (terms, _) in enumerate(texts) if len(terms)] if e is not None else []
        for i, (found, cosines) in zip(known, e.nearest_of([texts[i] for i in known], self.k) if known else [], strict=True):
            vote = e.vote(found, cosines)
            if vote >= 0:
                out[i] = float(np.interp(vote, *self.points)), [(e.ids[k], float(c), int(e.toxic[k])) for k, c in zip(found[:EVIDENCE].tolist(), cosines[:EVIDENCE].tolist(), strict=True)]
        return out


def fold(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 3, held: int = 1) -> Model:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(F.col(id_col), folds) != held))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Model(None, None, (np.zeros(1), np.zeros(1)), 0.0)
    if not sizes:
        return nothing
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE / sizes.get(1, 1))).otherwise(min(1.0, SAMPLE / sizes.get(0, 1)))
    drawn = broadcast_if_small(known.where(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20)) < share * (1 << 20)))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(drawn, "id")
    spark = docs.sparkSession
    found = sample.select("text").mapInArrow(released(_terms_of), "term long").distinct().mapInArrow(_packed, "term binary").collect()
    chosen = np.sort(np.frombuffer(b"".join(r["term"] for r in found), U64))
    shared = spark.sparkContext.broadcast(chosen)
    got = sorted(sample.select("id", "toxic", "text").mapInArrow(released(_vectors(shared)), "id long, toxic int, terms binary, tf binary").collect(), key=lambda r: (r["id"], r["terms"]))
    drawn_of = {c: sum(r["toxic"] == c for r in got) for c in (0, 1)}
    rate = {c: sizes.get(c, 0) / max(drawn_of[c], 1) for c in (0, 1)}
    with_terms = [r for r in got if r["terms"]]
    without = [r for r in got if not r["terms"]]
    bare = sizes.get(1, 0) / sum(sizes.values())
    if len(without) >= KS[0]:
        w = np.array([rate[r["toxic"]] for r in without])
        bare = float((w * [r["toxic"] for r in without]).sum() / w.sum())
    if not with_terms:
        return Model(None, None, (np.zeros(1), np.zeros(1)), bare)
    term = np.frombuffer(b"".join(r["terms"] for r in with_terms), np.int32)
    tf = np.frombuffer(b"".join(zlib.decompress(r["tf"]) for r in with_terms), np.int32)
    many = np.array([len(r["terms"]) // 4 for r in with_terms])
    ids, toxic = [r["id"] for r in with_terms], np.array([r["toxic"] for r in with_terms], float)
    weights = np.array([rate[r["toxic"]] for r in with_terms])
    del got, with_terms
    frequency = np.zeros(len(chosen) + 1, np.int64)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(released(_frequencies(shared)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counted.mapInArrow(_packed, "term binary, n binary").collect():
        frequency[np.frombuffer(r["term"], np.int64)] = np.frombuffer(r["n"], np.int64)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    index = spark.sparkContext.broadcast(Sample(term, tf, many, ids, toxic, weights, idf))

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e, at = index.value, np.asarray(batch.column(0)).tolist()
            found = e.nearest_of([e.text(i) for i in at], KS[-1], at)
            votes = [[e.vote(near[:k], cosines[:k]) for k in KS] for near, cosines in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.list_(pa.float64()))], names=["i", "votes"])

    drawn = spark.range(0, len(ids), 1, -(-len(ids) // 512)).where(F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(1 << 20)) < min(1.0, CALIBRATION / len(ids)) * (1 << 20))
    rows = drawn.mapInArrow(released(left_out), "i long, votes array<double>").collect()
    at, votes = np.array([r["i"] for r in rows], np.int64), np.array([r["votes"] for r in rows]).reshape(-1, len(KS))
    best = None
    for k, own in zip(KS, votes.T, strict=True):
        ok = own >= 0
        if ok.any():
            y, w = toxic[at][ok], weights[at][ok]
            points = isotonic(own[ok], y, w)
            error = float((w * (np.interp(own[ok], *points) - y) ** 2).sum() / w.sum())
            if best is None or error < best[0]:
                best = (error, k, points)
    if best is None:
        return Model(shared, index, (np.zeros(1), np.zeros(1)), bare)
    return Model(shared, index, best[2], bare, best[1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 3, held: int = 1, threshold: float = 0.7) -> DataFrame:
    """The rows of docs with held_out, score, predicted and evidence (array of doc_id, cosine, toxic).

    Columns of docs with these names are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted", "evidence")
    model = fit(docs, labels, id_col, text_col, label_col, folds, held)
    names = docs.columns
    at = names.index(text_col)
    own = docs.withColumn("held_out", F.coalesce(fold(F.col(id_col), folds) == held, F.lit(True)))
    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", evidence)])
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = model.chosen.value if model.chosen else np.zeros(0, U64)
        seen: dict[bytes, tuple[float, list[tuple[int, float, int]]]] = {}
        for batch, a, b, raw, offsets in _each_chunk(batches, at):
            rows, terms, tf = text_terms(raw, offsets, chosen)
            cuts = np.searchsorted(rows, np.arange(b - a + 1))
            texts = [(terms[i:j].astype(np.int64), tf[i:j]) for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            keys = [hashlib.blake2b(t.tobytes() + f.tobytes(), digest_size=16).digest() for t, f in texts]
            new = {k: i for i, k in enumerate(keys) if k not in seen}
            now = dict(zip(new, model.scores([texts[i] for i in new.values()]), strict=True))
            got = [now[k] if k in now else seen[k] for k in keys]
            if len(seen) >= 10_000:
                seen.clear()
            seen |= now
            scores = [s for s, _ in got]
            proofs = [[{"doc_id": d, "cosine": c, "toxic": y} for d, c, y in proof] for _, proof in got]
            part = batch.slice(a, b - a)
            added = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(proofs, kind)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*names, "held_out", "score", "predicted", "evidence"])

    return own.mapInArrow(released(run), schema)
