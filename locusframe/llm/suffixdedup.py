"""Operator 9: repeated ``LENGTH``-byte strings by sharded suffix arrays.

A byte goes when a ``LENGTH``-byte string that covers it also starts earlier (smaller
doc_id, or the same document at an earlier start). Strings do not cross documents.

Suffix arrays of arbitrary shards would have to be merged pair by pair, which grows with
the square of their number. Here the shard of a string is a function of its content, so
that equal strings meet in one shard and no merge is left over:

1. Every string belongs to the least hash of its K-byte grams (its minimizer). Strings
   with consecutive starts and one minimizer form a stretch. Of a task's equal stretches
   only the first is sent on, the others go at once; so a line of every text is sent once
   for some FLUSH stretches. Tasks send a stretch's minimizer, hashes and place, dealt by
   minimizer.
2. A stretch whose minimizer occurs nowhere else is unique. Of equal stretches (by two
   independent 64-bit hashes) all but the first go whole. Only where stretches of a
   minimizer differ (the edges of repeated passages), the first of each kind is looked at
   byte by byte:
3. the stretches' bytes are joined in a shard; its suffix array is refined by
   Larsson-Sadakane doubling in numpy (only unsorted groups are sorted again). Kasai's scan,
   in lanes of the text side by side, gives the common prefix of neighbours in it; runs of
   LENGTH bytes and more are equal strings, of which all but the first start are removed.
   A minimizer with more than HOT kinds of stretches is split over shards of that many;
   strings that are first in one part are merged with the other parts' by hash and bytes.
4. Each text is joined with its removed spans.

Very long texts: a text's stretches are made at once, in some 40 times its bytes.
Nulls: a null text is empty; a null doc_id comes after all others, as the greatest id does. Rows with one doc_id
are ordered by their text's hash; of equal rows, the first keeps what the row keeps and
the others count as repeated from the start. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BYTE_VALUES, U64, chunks, mix, powers, prefix_hashes, ragged, released, shards_for, span_hashes, text_buffer, written

LENGTH = 100
K = 51
WINDOW = LENGTH - K + 1
MOST_STARTS = 250
BYTES_A_SHARD = 12 << 20
FLUSH = 1_500_000
SLICE = 1 << 20
HOT = 2000
LAST = (1 << 63) - 1
_LOW = U64((1 << 40) - 1)
#: Lanes of Kasai's scan are this long.
LANE = 64
_SECOND = mix(BYTE_VALUES + U64(0x632BE59BD9B4E019)) | U64(1)


def _slide(x: np.ndarray, f: np.ufunc) -> np.ndarray:
    """f over every WINDOW consecutive values."""
    have = 1
    while have * 2 <= WINDOW:
        x = f(x[:-have], x[have:])
        have *= 2
    rest = WINDOW - have
    return f(x[:-rest], x[rest:]) if rest else x


def stretches(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, number of starts, minimizer, two hashes and whether the minimizer recurs inside."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none.astype(U64), none.astype(U64), none.astype(U64), none.astype(bool)
    prefix = prefix_hashes(BYTE_VALUES[raw])
    grams = mix((prefix[K:] - prefix[:-K]) * powers(n + 1)[1][: n - K + 1])
    least = _slide(grams, np.minimum)
    valid = np.ones(n, bool)
    tail = np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1)
    valid[ragged(tail, offsets[1:] - tail)] = False
    valid = valid[: len(least)]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | first[1:]
    s, e = np.flatnonzero(first), np.flatnonzero(stop) + 1
    long = e - s > MOST_STARTS
    again = long.copy()
    # Grams that are least of some window, and those of them that a stretch has more than once.
    padded = np.zeros(len(least) + 2 * (WINDOW - 1), U64)
    padded[WINDOW - 1 : WINDOW - 1 + len(least)] = np.where(valid, least, U64(0))
    at = np.flatnonzero(_slide(padded, np.maximum) == grams)
    lo, hi = np.searchsorted(at, s), np.searchsorted(at, e - 1 + WINDOW)
    again |= hi - lo > 8
    seen = np.zeros(len(s), np.int64)
    for j in range(8):
        here = lo + j < hi
        seen[here] += grams[at[lo[here] + j]] == least[s[here]]
    again |= seen > 1
    if long.any():
        parts = np.where(long, -(-(e - s) // MOST_STARTS), 1)
        cut = ragged(np.zeros(len(s), np.int64), parts) * MOST_STARTS
        s, e, again = np.repeat(s, parts) + cut, np.repeat(e, parts), np.repeat(again, parts)
        e = np.minimum(e, s + np.where(np.repeat(long, parts), MOST_STARTS, 1 << 30))
    # Least values crowd at the low end; mixed again, they spread over the shards.
    first_hash = span_hashes(prefix, s, e + LENGTH - 1)
    del prefix, grams, padded
    return s, e - s, mix(least[s] + U64(1)), first_hash, span_hashes(prefix_hashes(_SECOND[raw]), s, e + LENGTH - 1), again


def _text_ranks(key: np.ndarray, th: np.ndarray) -> np.ndarray:
    """The order of texts by (key, th); equal ones are one text."""
    by = np.lexsort((th, key))
    rank = np.empty(len(key), np.int64)
    rank[by] = np.cumsum(np.concatenate([[False], (key[by][1:] != key[by][:-1]) | (th[by][1:] != th[by][:-1])])[: len(by)])
    return rank


def repeats_among(rank: np.ndarray, at: np.ndarray, v: np.ndarray, h: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal stretches, which are first (or alone), and which stand at a later place; one of those at the same place."""
    order = np.argsort(h)
    equal = h[order][1:] == h[order][:-1]
    some = order[np.append(equal, False) | np.append(False, equal)] if len(order) else order
    first, later = np.ones(len(h), bool), np.zeros(len(h), bool)
    own = some[np.lexsort((at[some], rank[some], h2[some], v[some], h[some]))]
    new = np.ones(len(own), bool)
    new[1:] = (h[own][1:] != h[own][:-1]) | (v[own][1:] != v[own][:-1]) | (h2[own][1:] != h2[own][:-1])
    place = new.copy()
    place[1:] |= (rank[own][1:] != rank[own][:-1]) | (at[own][1:] != at[own][:-1])
    first[own[~new]] = False
    later[own[place & ~new]] = True
    return first, later


#: Stretches; or, with an empty doc, spans that a task has found: at is their starts, n their ends.
PLACED = "shard int, keys binary, ths binary, doc binary, at binary, n binary, low binary, hash binary, second binary, again binary"


def _deal(shards: int):
    names = [x.split()[0] for x in PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        keys: list[np.ndarray] = []
        ths: list[np.ndarray] = []
        docs = count = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, count
            doc, at, n, v, h, h2, again = (np.concatenate(c) for c in zip(*held, strict=True))
            key, th = np.concatenate(keys), np.concatenate(ths)
            rank = _text_ranks(key, th)
            first, later = repeats_among(rank[doc], at, v, h, h2)
            rows = []
            if later.any():
                gone = np.flatnonzero(later)
                gone = gone[np.lexsort((at[gone], rank[doc[gone]]))]
                start, end, text = at[gone], at[gone] + n[gone] + LENGTH - 1, rank[doc[gone]]
                # Ends grow with the starts in a text: spans that meet are one.
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (start[1:] > end[:-1])])
                last = np.append(np.flatnonzero(new)[1:] - 1, len(gone) - 1)
                who = doc[gone][new]
                rows.append((int(th[who[0]] % shards), key[who].tobytes(), th[who].tobytes(), b"", start[new].astype("<u4").tobytes(), end[last].astype("<u4").tobytes(), b"", b"", b"", b""))
            doc, at, n, v, h, h2, again = (x[first] for x in (doc, at, n, v, h, h2, again))
            shard = ((v >> U64(40)) * U64(shards)) >> U64(24)
            order = np.argsort(shard.astype(np.uint16) if shards < 65536 else shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=U64))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[k] : cuts[k + 1]]
                who, local = np.unique(doc[own], return_inverse=True)
                low = np.ascontiguousarray((v[own] & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
                rows.append((k, key[who].tobytes(), th[who].tobytes(), local.astype("<u4").tobytes(), at[own].astype("<u4").tobytes(), n[own].astype(np.uint8).tobytes(), low.tobytes(), h[own].tobytes(), h2[own].tobytes(), again[own].tobytes()))
            held.clear()
            keys.clear()
            ths.clear()
            docs = count = 0
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)

        for batch in batches:
            key, th = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            raw, offsets = text_buffer(batch.column(2))
            for a, b in chunks(offsets):
                part = offsets[a : b + 1] - offsets[a]
                s, n, v, h, h2, again = stretches(raw[offsets[a] : offsets[b]], part)
                if len(s):
                    row = np.searchsorted(part, s, "right") - 1
                    held.append((row + docs, s - part[row], n, v, h, h2, again))
                    count += len(s)
                keys.append(key[a:b])
                ths.append(th[a:b])
                docs += b - a
                if count >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


#: spans: start and end (removed), as pairs of 32 bits. open: start, starts, hot; groups: 64 bits.
FOUND = "key long, th long, spans binary, groups binary, open binary"


def _per_row(key: np.ndarray, th: np.ndarray, spans: np.ndarray, groups: np.ndarray, opened: np.ndarray, is_open: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each (key, th); spans or opened places as byte strings."""
    order = np.lexsort((is_open, th, key))
    key, th, spans, groups, opened, is_open = key[order], th[order], spans[order], groups[order], opened[order], is_open[order]
    cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (th[1:] != th[:-1]), [True]]))
    for a in range(0, len(cut) - 1, 5000):
        rows = []
        for i, j in zip(cut[a : a + 5000].tolist(), cut[a + 1 : a + 5001].tolist(), strict=False):
            m = i + int(np.searchsorted(is_open[i:j], True))
            rows.append((spans[i:m].tobytes(), groups[m:j].tobytes(), opened[m:j].tobytes()))
        x = cut[a : a + 5000][: len(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(key[x]), pa.array(th[x]), *[pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]], names=[c.split()[0] for c in FOUND.split(", ")])


def _meet(hot: int):
    return lambda batches: _meet_shard(batches, hot)


def _meet_shard(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """A shard: repeated stretches as removed spans; places where stretches of a minimizer differ.

    A minimizer with more than ``hot`` kinds of stretches is split into groups of that many.
    """
    cols: list[list] = [[] for _ in range(9)]
    base = 0
    for batch in batches:
        for row in batch.to_pylist():
            if not row["doc"]:
                own = [np.frombuffer(row[c], np.int64) for c in ("keys", "ths")]
                span = np.stack([np.frombuffer(row[c], "<u4") for c in ("at", "n")], 1)
                no = np.zeros(len(span), bool)
                yield from _per_row(*own, span, no.astype(U64), span, no)
                continue
            cols[0].append(np.frombuffer(row["keys"], np.int64))
            cols[1].append(np.frombuffer(row["ths"], np.int64))
            cols[2].append(np.frombuffer(row["doc"], "<u4").astype(np.int64) + base)
            base += len(cols[0][-1])
            cols[3].append(np.frombuffer(row["at"], "<u4"))
            cols[4].append(np.frombuffer(row["n"], np.uint8))
            low = np.zeros((len(cols[4][-1]), 8), np.uint8)
            low[:, :5] = np.frombuffer(row["low"], np.uint8).reshape(-1, 5)
            cols[5].append(low.reshape(-1).view("<u8") | U64(row["shard"] << 40))
            cols[6].append(np.frombuffer(row["hash"], U64))
            cols[7].append(np.frombuffer(row["second"], U64))
            cols[8].append(np.frombuffer(row["again"], bool))
    if not base:
        return
    keys, ths, doc, at, n, v, h, h2, again = (np.concatenate(c) for c in cols)
    del cols
    # Minimizers of more than one stretch, or of one that may repeat inside.
    order = np.argsort(v)
    ranked = v[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])
    lone = first[:-1] & first[1:]
    own = order[~lone | again[order]]
    doc, at, n, v, h, h2, again = (x[own] for x in (doc, at, n, v, h, h2, again))
    if not len(doc):
        return
    rank = _text_ranks(keys, ths)
    order = np.lexsort((at, rank[doc], h2, h, v))
    doc, at, n, v, h, h2, again = (x[order] for x in (doc, at, n, v, h, h2, again))
    new_v = np.concatenate([[True], v[1:] != v[:-1]])
    new_h = new_v | np.concatenate([[True], (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])])
    same = np.concatenate([[False], (rank[doc][1:] == rank[doc][:-1]) & (at[1:] == at[:-1])]) & ~new_h
    group = np.cumsum(new_v) - 1
    kinds = np.bincount(group, new_h)
    look = np.zeros(len(kinds), bool)
    np.logical_or.at(look, group, again)
    look |= kinds > 1
    is_open = new_h & look[group]
    is_hot = (kinds > hot)[group]
    kind = np.cumsum(new_h) - 1
    part = (kind - kind[np.flatnonzero(new_v)][group]) // hot
    v = np.where(is_hot, mix(v + (part + 1).astype(U64) * U64(0xD6E8FEB86659FD93)), v)
    take = is_open | (~new_h & ~same)
    doc, at, n, v, is_open, is_hot = doc[take], at[take], n[take].astype(np.int64), v[take], is_open[take], is_hot[take]
    if not len(doc):
        return
    spans = np.stack([at, at + n + LENGTH - 1], 1).astype("<u4")
    opened = np.stack([at, n, is_hot], 1).astype("<u4")
    yield from _per_row(keys[doc], ths[doc], spans, v, opened, is_open)


OPENED = "shard int, key long, th long, groups binary, open binary, data binary"


def _cut_out(shards: int):
    """The opened stretches' bytes, dealt by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                text = row["data"]
                groups = np.concatenate([np.frombuffer(x, U64) for x in row["groups"]])
                opened = np.concatenate([np.frombuffer(x, "<u4").reshape(-1, 3) for x in row["open"]])
                shard = mix(groups) % U64(shards)
                for k in np.unique(shard).tolist():
                    own = np.flatnonzero(shard == k)
                    data = b"".join(text[s : s + n + LENGTH - 1] for s, n, _ in opened[own].tolist())
                    rows.append((k, row["key"], row["th"], groups[own].tobytes(), opened[own].tobytes(), data))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in OPENED.split(", ")])

    return run


def _rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks (the place of a group's first in sorted order), the order, and whether a place's group has others."""
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    place = np.flatnonzero(first)
    size = np.diff(np.append(place, len(keys)))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.repeat(place, size)
    return rank, order, np.repeat(size > 1, size)


def suffix_ranks(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Ranks of all suffixes; with a depth (a power of two from 8 on) by so many first bytes, of which equal ones share a rank.

    Larsson-Sadakane: groups of equal rank are sorted by the rank h bytes further on;
    suffixes whose group has no other member are finished and never sorted again.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.zeros(n, U64)
    for i in range(8):
        words |= padded[i : i + n].astype(U64) << U64(8 * (7 - i))
    rank, order, more = _rank(words)
    del words
    left, h = order[more], 8
    while h < (depth or n) and len(left):
        far = left + h
        key = (rank[left].astype(U64) << U64(32)) | np.where(far < n, rank[np.minimum(far, n - 1)] + 1, 0).astype(U64)
        order = np.argsort(key)
        ranked, left = key[order], left[order]
        top = ranked >> U64(32)
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        head = np.concatenate([[True], top[1:] != top[:-1]])
        place = np.arange(len(left))
        base = np.maximum.accumulate(np.where(head, place, 0))
        group = np.maximum.accumulate(np.where(first, place, 0))
        rank[left] = top.astype(np.int64) + group - base
        size = np.diff(np.append(np.flatnonzero(first), len(left)))
        left = left[np.repeat(size > 1, size)]
        h *= 2
    return rank


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix of the array shares with the one before it.

    Kasai's scan: a suffix shares at least one byte less with its neighbour than the suffix
    that starts one byte earlier, so comparing goes on from there. Lanes of ``LANE`` starts
    are scanned side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int16)
    padded = np.concatenate([text, np.zeros(most, np.uint8)])
    start = np.arange(0, n, LANE)
    have = np.zeros(len(start), np.int64)
    for step in range(LANE):
        i = start + step
        lanes = np.flatnonzero(i < n)
        i, j, h = i[lanes], before[i[lanes]], have[lanes]
        h = np.where(j >= 0, np.maximum(h - 1, 0), 0)
        go = np.flatnonzero(j >= 0)
        while len(go):
            x, y = i[go] + h[go], j[go] + h[go]
            go = go[(h[go] < most) & (x < n) & (y < n) & (padded[np.minimum(x, n)] == padded[np.minimum(y, n)])]
            h[go] += 1
        out[i], have[lanes] = h, h
    return out[order]


def repeated_starts(text: np.ndarray, starts: np.ndarray, order_key: np.ndarray) -> np.ndarray:
    """Which of the LENGTH-byte strings at ``starts`` are equal to one of smaller order_key."""
    out = np.zeros(len(starts), bool)
    if not len(starts):
        return out
    order = np.argsort(suffix_ranks(text))
    run = np.cumsum(common_prefixes(text, order) < LENGTH)
    of = np.empty(len(text), np.int64)
    of[order] = run
    # Strings of one run of the array are equal; the least start of a run stays.
    by = np.lexsort((order_key, of[starts]))
    ranked = of[starts][by]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    out[by] = ~first
    return out


#: Removed spans of a text; or, of split groups, a string's place, hash and first bytes.
RESOLVED = "key long, th long, spans binary, start long, h long, w long"


def _resolve(slice_bytes: int):
    return lambda batches: _resolve_shard(batches, slice_bytes)


def _resolve_shard(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """A shard's opened stretches: the strings among them that start earlier too."""
    keys, ths, groups, at, rows, data = [], [], [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            opened = np.frombuffer(row["open"], "<u4").reshape(-1, 3).astype(np.int64)
            keys.append(row["key"])
            ths.append(row["th"])
            groups.append(np.frombuffer(row["groups"], U64))
            rows.append(len(opened))
            at.append(opened)
            data.append(row["data"])
    if not rows:
        return
    key, th = np.repeat(np.array(keys, np.int64), rows), np.repeat(np.array(ths, np.int64), rows)
    (at, n, hot), group = np.concatenate(at).T, np.concatenate(groups)
    text = np.frombuffer(b"".join(data), np.uint8)
    del data, groups
    size = n + LENGTH - 1
    begin = np.cumsum(size) - size
    # Whole groups, some slice_bytes at a time.
    order = np.argsort(group, kind="stable")
    key, th, at, n, hot, group, size, begin = (x[order] for x in (key, th, at, n, hot, group, size, begin))
    ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1
    upto = np.cumsum(size)[ends - 1]
    a = taken = 0
    while a < len(n):
        b = int(ends[min(max(int(np.searchsorted(upto, taken + slice_bytes, "right")) - 1, int(np.searchsorted(ends, a, "right"))), len(ends) - 1)])
        yield from _resolve_slice(key[a:b], th[a:b], at[a:b], n[a:b], hot[a:b] > 0, text[ragged(begin[a:b], size[a:b])])
        a, taken = b, int(upto[np.searchsorted(ends, b)])


def _resolve_slice(key: np.ndarray, th: np.ndarray, at: np.ndarray, n: np.ndarray, hot: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESOLVED.split(", ")]
    begin = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
    order = np.lexsort((at, th, key))
    place = np.empty(len(at), np.int64)
    place[order] = np.arange(len(at))
    starts = ragged(begin, n)
    inside = ragged(np.zeros(len(n), np.int64), n)
    owner = np.repeat(np.arange(len(n)), n)
    gone = repeated_starts(text, starts, place[owner] * (1 << 16) + inside)
    left = np.flatnonzero(hot[owner] & ~gone)
    if len(left):
        prefix = prefix_hashes(BYTE_VALUES[text])
        for i in range(0, len(left), 50_000):
            own = left[i : i + 50_000]
            s = starts[own]
            words = np.ascontiguousarray(text[s[:, None] + np.arange(8)]).reshape(-1).view("<i8")
            who = owner[own]
            yield pa.RecordBatch.from_arrays([pa.array(key[who]), pa.array(th[who]), pa.nulls(len(own), pa.binary()), pa.array(at[who] + inside[own]), pa.array(span_hashes(prefix, s, s + LENGTH).view(np.int64)), pa.array(words)], names=names)
    if not gone.any():
        return
    # Runs of removed starts inside a stretch.
    before = np.concatenate([[False], gone[:-1] & (owner[1:] == owner[:-1])])
    after = np.concatenate([gone[1:] & (owner[1:] == owner[:-1]), [False]])
    s, e = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    own = owner[s]
    spans = np.stack([at[own] + inside[s], at[own] + inside[e] + LENGTH], 1).astype("<u4")
    for found in _per_row(key[own], th[own], spans, np.zeros(len(own), U64), spans, np.zeros(len(own), bool)):
        none = pa.nulls(found.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*found.columns[:3], none, none, none], names=names)


RESULT = "key long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            data = row["data"] or b""
            found = [np.frombuffer(x, "<u4").reshape(-1, 2) for x in row["spans"] or ()]
            if row["starts"]:
                found.append(np.array([[x, x + LENGTH] for x in row["starts"]]))
            if row["copy"] > 1 and len(data) >= LENGTH:
                found = [np.array([[0, len(data)]])]
            merged: list[list[int]] = []
            if found:
                s = np.concatenate(found).astype(np.int64)
                for a, b in s[np.lexsort((s[:, 1], s[:, 0]))].tolist():
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            rows.append((row["key"], len(data), sum(b - a for a, b in merged), [{"start": a, "end": b} for a, b in merged], b"".join(kept)))
        if rows:
            cols = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in ("key", "n_bytes", "n_removed", "spans", "kept")])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, slice_bytes: int = SLICE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): removed byte spans and the remaining bytes."""
    shards = shards_for(docs, BYTES_A_SHARD)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("key"), F.xxhash64(text).alias("th"), text.alias("text"))
    placed = texts.where(F.octet_length("text") >= LENGTH).drop("id").mapInArrow(released(_deal(shards)), PLACED)
    met = written(placed.repartitionById(shards, "shard").mapInArrow(released(_meet(hot)), FOUND), "met")
    opened = met.where(F.octet_length("groups") > 0).groupBy("key", "th").agg(F.collect_list("groups").alias("groups"), F.collect_list("open").alias("open"))
    bytes_of = texts.where(F.octet_length("text") >= LENGTH).select("key", "th", F.col("text").cast("binary").alias("data"))
    # Equal rows are one text here.
    cut = opened.join(bytes_of, ["key", "th"]).dropDuplicates(["key", "th"]).mapInArrow(released(_cut_out(shards)), OPENED)
    resolved = written(cut.repartitionById(shards, "shard").mapInArrow(released(_resolve(slice_bytes)), RESOLVED), "resolved")
    # Strings that several parts of a split group have: all but the first of all parts go.
    split = resolved.where("h IS NOT NULL")
    first = written(split.groupBy("h", "w").agg(F.min(F.struct("key", "th", "start")).alias("first"), F.count("*").alias("k")).where("k > 1").select("h", "w", "first"), "firsts")
    again = split.join(first, ["h", "w"]).where(F.struct("key", "th", "start") > F.col("first")).select("key", "th", F.lit(None).cast("binary").alias("spans"), "start")
    start = F.lit(None).cast("long").alias("start")
    spans = met.where(F.octet_length("spans") > 0).select("key", "th", "spans", start).union(resolved.where("spans IS NOT NULL").select("key", "th", "spans", start)).union(again)
    spans = spans.groupBy("key", "th").agg(F.collect_list("spans").alias("spans"), F.collect_list("start").alias("starts"))
    same = W.partitionBy("key", "th").orderBy("key")
    rows = texts.select("id", "key", "th", F.col("text").cast("binary").alias("data")).withColumn("copy", F.row_number().over(same))
    found = rows.join(spans, ["key", "th"], "left").select(F.col("id").alias("key"), "data", "copy", "spans", "starts").mapInArrow(released(_keep), RESULT)
    return found.withColumnRenamed("key", "doc_id").select("doc_id", "n_bytes", "n_removed", "spans", "kept")
