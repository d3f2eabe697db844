"""Operator 2: secrets, by patterns and by formats inferred from labelled credentials.

The base kinds are three patterns (leftmost, non-overlapping within a kind). Their
matches are labelled credentials: of each kind the ``SAMPLE`` distinct values of least
hash, over all texts, go into a prefix tree, whose states are merged while they are
statistically compatible (ALERGIA: red and blue states, Hoeffding bound at ``ALPHA``)
into a probabilistic automaton; a kind of fewer than ``LEAST_LABELLED`` values gets none.

Every other candidate is scored: a run of credential characters that meets no base match
and is at least as long as the shortest labelled value, as a whole, without closing
punctuation, and what follows its ``=`` signs, each in turn. Its score is its log
likelihood per character under the best automaton, less that under a character-pair model
of the sampled candidates. The reading of best score is a span of kind ``format`` if its
likelihood is no worse than that of all but ``TAIL`` of the labelled values and the score
is at least ``LEAST_GAIN``.

Nulls and empty texts have no spans. Very long texts: base matches and candidates are
walked through once, in order; the readings of a run with many ``=`` signs are scored
together, from its end to its start, so its cost is linear in its length. Rows are scanned each on its own; repeated rows and null
ids are kept. Without a labelled value there are no format spans.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, released, spans_of, text_buffer, written

SAMPLE = 300
ALPHA = 0.05
TAIL = 0.02
LEAST_GAIN = 0.4
KINDS = ("assign", "access", "hex", "format")
LEAST_LABELLED = 10
#: The least length of a base match's value.
SHORTEST = 6
#: Starts in a run up to which its readings are scored one by one, and letters of runs whose result is kept.
FEW_STARTS = 6
KEPT = 200

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_WORDS = ("passw", "secret", "token", "api")

_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[97:103] = True
_CRED = np.zeros(256, bool)
_CRED[list(b"+/_.=-")] = _CRED[48:58] = _CRED[65:91] = _CRED[97:123] = True

Span = tuple[int, int, int]
Span2 = tuple[int, int]


def base_spans(text: str, has_hex: bool = True) -> list[Span]:
    """(start, kind, end) of the base patterns' matches, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if has_hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out)


def candidates(runs: list[Span2], base: list[Span]) -> Iterator[Span2]:
    """The runs that meet no base match; both in order."""
    at = 0
    for s, e in runs:
        while at < len(base) and base[at][2] <= s:
            at += 1
        # What is passed over or stands behind this match ends before s or starts behind it.
        if at == len(base) or base[at][0] >= e:
            yield s, e


def borders(run: str) -> tuple[list[int], list[int]]:
    """Where what may be the credential starts in a run, at its start or behind = signs, and where it ends, closing punctuation in or out."""
    starts = [0, *[m.end() for m in re.finditer(r"=+(?=[^=])", run)]]
    return starts, sorted({len(run), len(run.rstrip(".")), len(run.rstrip(".=-_/+"))}, reverse=True)


def readings(run: str, least: int) -> Iterator[tuple[int, int]]:
    """Places in a run of what may be the credential."""
    starts, ends = borders(run)
    for a in starts:
        for b in ends:
            if b - a >= least:
                yield a, b


def _scan(batch: pa.RecordBatch, column: int, least: int) -> Iterator[tuple[int, str, list[Span], list[Span2]]]:
    """Row, text, base spans and the runs of ``least`` credential characters, for every row of a batch."""
    raw, offsets = text_buffer(batch.column(column))
    for a, b in chunks(offsets):
        part = offsets[a : b + 1] - offsets[a]
        own = raw[offsets[a] : offsets[b]]
        s, e = spans_of(_HEX[own], part)
        hexed = np.zeros(b - a, bool)
        hexed[np.searchsorted(part, s[e - s >= 24], "right") - 1] = True
        s, e = spans_of(_CRED[own], part)
        long = e - s >= least
        s, e = s[long], e[long]
        # Places in code points.
        points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
        row = np.searchsorted(part, s, "right") - 1
        s, e = points[s] - points[part[row]], points[e] - points[part[row]]
        cuts = np.searchsorted(row, np.arange(b - a + 1)).tolist()
        pairs = list(zip(s.tolist(), e.tolist(), strict=True))
        data = own.tobytes()
        for i in range(b - a):
            text = data[part[i] : part[i + 1]].decode()
            yield a + i, text, base_spans(text, bool(hexed[i])), pairs[cuts[i] : cuts[i + 1]]


def _added(terms: Iterable[float]) -> float:
    """One after the other, as sums over suffixes are; sum() rounds otherwise."""
    total = 0.0
    for x in terms:
        total += x
    return total


class Automaton:
    """A probabilistic automaton from strings, by merging compatible prefix-tree states."""

    def __init__(self, strings: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.n: list[Counter] = [Counter()]
        for s in strings:
            state = 0
            for c in s:
                self.n[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.n.append(Counter())
                state = self.next[state][c]
            self.n[state][""] += 1
        self.total = [sum(n.values()) for n in self.n]
        self._merge()
        self.common = Counter()
        for state in self.states:
            self.common.update(self.n[state])
        self.sum = sum(self.common.values()) or 1

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            x, y = self.total[a], self.total[b]
            if not x or not y:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(x) + 1 / math.sqrt(y))
            for c in self.n[a].keys() | self.n[b].keys():
                if abs(self.n[a][c] / x - self.n[b][c] / y) > bound:
                    return False
            stack += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree b to the state a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.n[a].update(self.n[b])
            self.total[a] += self.total[b]
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    stack.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge(self) -> None:
        red = [0]
        while True:
            blue = sorted(((self.total[t], s, c, t) for s in red for c, t in self.next[s].items() if t not in red), reverse=True)
            if not blue:
                break
            _, s, c, t = blue[0]
            for r in red:
                if self._compatible(r, t):
                    self.next[s][c] = r
                    self._fold(r, t)
                    break
            else:
                red.append(t)
        self.states = red

    def step(self, state: int, c: str) -> tuple[float, int]:
        """Log likelihood of a character (or "" for the end) in a state, and the next state; missing steps are smoothed."""
        p = (self.n[state][c] + 0.5 * (self.common[c] + 0.01) / (self.sum + 1)) / (self.total[state] + 0.5)
        return math.log(p), self.next[state].get(c, 0) if c else state

    def per_char(self, s: str) -> float:
        """Log likelihood, with the end, divided by the length and one; added up from the end."""
        state, terms = 0, []
        for c in (*s, ""):
            p, state = self.step(state, c)
            terms.append(p)
        return _added(reversed(terms)) / (len(s) + 1)

    def suffixes(self, run: str, ends: list[int], starts: list[int]) -> np.ndarray:
        """per_char of run[a:b] for all ends (rows) and starts (columns), in one pass from the end over all states; -inf for none."""
        place = {state: k for k, state in enumerate(self.states)}
        tables = {}
        for c in set(run):
            steps = [self.step(state, c) for state in self.states]
            tables[c] = np.array([p for p, _ in steps]), np.array([place[to] for _, to in steps])
        closing = np.array([self.step(state, "")[0] for state in self.states])
        out = np.full((len(ends), len(starts)), -np.inf)
        column = {a: k for k, a in enumerate(starts)}
        total = np.full((len(ends), len(self.states)), -np.inf)
        for at in range(len(run), -1, -1):
            for k, b in enumerate(ends):
                if b == at:
                    total[k] = closing
            if at in column:
                out[:, column[at]] = total[:, place[0]]
            if at:
                p, to = tables[run[at - 1]]
                total = p + total[:, to]
        return out / (np.array(ends)[:, None] - np.array(starts)[None, :] + 1).clip(1)


class Background:
    """A character-pair model of candidates that are not credentials."""

    def __init__(self, strings: list[str]) -> None:
        self.pairs, self.firsts = Counter(), Counter()
        for s in strings:
            for a, b in zip(" " + s, s + " ", strict=True):
                self.pairs[a + b] += 1
                self.firsts[a] += 1

    def pair(self, a: str, b: str) -> float:
        return math.log((self.pairs[a + b] + 0.5) / (self.firsts[a] + 34.0))

    def per_char(self, s: str) -> float:
        return _added(self.pair(a, b) for a, b in reversed(list(zip(" " + s, s + " ", strict=True)))) / (len(s) + 1)

    def suffixes(self, run: str, ends: list[int], starts: list[int]) -> np.ndarray:
        """per_char of run[a:b] for all ends (rows) and starts (columns)."""
        known: dict[str, float] = {}
        score = lambda two: known[two] if two in known else known.setdefault(two, self.pair(two[0], two[1]))
        out = np.full((len(ends), len(starts)), -np.inf)
        column = {a: k for k, a in enumerate(starts)}
        for k, b in enumerate(ends):
            total = 0.0
            for at in range(b - 1, -1, -1):
                total += score(run[at] + (run[at + 1] if at + 1 < b else " "))
                if at in column:
                    out[k, column[at]] = (total + score(" " + run[at])) / (b - at + 1)
        return out


class Formats:
    def __init__(self, labelled: dict[str, list[str]], others: list[str]) -> None:
        self.background = Background(others)
        self.known = []
        self.least = min((len(s) for strings in labelled.values() for s in strings), default=SHORTEST)
        for _, strings in sorted(labelled.items()):
            if len(strings) >= LEAST_LABELLED:
                automaton = Automaton(strings)
                scores = sorted(automaton.per_char(s) for s in strings)
                self.known.append((automaton, scores[int(TAIL * len(scores))]))

    def score(self, s: str) -> float | None:
        """The gain over the background if the string has a known format."""
        plain, best = self.background.per_char(s), None
        for automaton, least in self.known:
            p = automaton.per_char(s)
            if p >= least and p - plain >= LEAST_GAIN and (best is None or p - plain > best):
                best = p - plain
        return best

    def best(self, run: str) -> tuple[int, int, float] | None:
        """The reading of a run that scores best, the first and longest of equal ones."""
        starts, ends = borders(run)
        if len(starts) > FEW_STARTS:
            return self._best_of_many(run, starts, ends)
        found = None
        for a, b in readings(run, self.least):
            gain = self.score(run[a:b])
            if gain is not None and (found is None or gain > found[2]):
                found = (a, b, gain)
        return found

    def _best_of_many(self, run: str, starts: list[int], ends: list[int]) -> tuple[int, int, float] | None:
        """The same in time linear in the run."""
        plain = self.background.suffixes(run, ends, starts)
        best = np.full(plain.shape, -np.inf)
        long = np.array(ends)[:, None] - np.array(starts)[None, :] >= self.least
        for automaton, least in self.known:
            p = automaton.suffixes(run, ends, starts)
            with np.errstate(invalid="ignore"):
                gain = p - plain
            best = np.maximum(best, np.where(long & (p >= least) & (gain >= LEAST_GAIN), gain, -np.inf))
        k = int(np.argmax(best.T))
        a, b = divmod(k, len(ends))
        return (starts[a], ends[b], float(best[b, a])) if best[b, a] > -np.inf else None


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's SAMPLE distinct values of least hash, of each kind; candidates are kind 3."""
    heaps: list[list] = [[], [], [], []]
    held: list[set] = [set(), set(), set(), set()]
    for batch in batches:
        for _, text, base, runs in _scan(batch, 0, SHORTEST):
            values = [(k, ASSIGN.match(text[s:e])[2] if k == 0 else text[s:e]) for s, k, e in base]
            values += [(3, text[s:e]) for s, e in candidates(runs, base)]
            for k, value in values:
                rank = -xxhash.xxh32_intdigest(value)
                if value in held[k] or (len(heaps[k]) >= SAMPLE and rank <= heaps[k][0][0]):
                    continue
                held[k].add(value)
                if len(heaps[k]) >= SAMPLE:
                    held[k].discard(heapq.heappushpop(heaps[k], (rank, value))[1])
                else:
                    heapq.heappush(heaps[k], (rank, value))
    rows = [(k, -rank, value) for k in range(4) for rank, value in heaps[k]]
    if rows:
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["kind", "rank", "value"])


def fit(texts: DataFrame) -> Formats:
    found = written(texts.mapInArrow(released(_labelled), "kind int, rank long, value string"), "credentials")
    of = {k: [r["value"] for r in found.where(F.col("kind") == k).select("rank", "value").distinct().orderBy("rank", "value").limit(SAMPLE).collect()] for k in range(4)}
    return Formats({KINDS[k]: of[k] for k in range(3)}, of[3])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans are (kind, start, end, value, gain) by start, then kind; code points, end exclusive."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    formats = docs.sparkSession.sparkContext.broadcast(fit(texts.select("text")))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("gain", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Formats = formats.value
        seen: dict[str, tuple[int, int, float] | None] = {}
        for batch in batches:
            out: list[list] = [[]] * batch.num_rows
            for i, text, base, runs in _scan(batch, 1, model.least):
                spans = [(s, k, e, None) for s, k, e in base]
                for s, e in candidates(runs, base) if model.known else ():
                    run = text[s:e]
                    found = seen[run] if run in seen else model.best(run)
                    if len(run) <= KEPT:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen[run] = found
                    if found is not None:
                        x, y, gain = found
                        spans.append((s + x, 3, s + y, gain))
                out[i] = [{"kind": KINDS[k], "start": s, "end": e, "value": text[s:e], "gain": g} for s, k, e, g in sorted(spans, key=lambda x: x[:3])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return texts.mapInArrow(released(run), "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string,gain:double>>")


def written_spans(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
