"""Operator 8: language identification by segmentation-marginalised unigrams.

A language is a unigram model over the pieces of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, by the forward algorithm;
a text's is the product over its words (runs of letters in lower case, each behind the
vocabulary's word mark). The models are fitted by expectation maximisation (forward and
backward over all segmentations) on about ``TRAIN_DOCS`` labelled texts a language, taken
by a hash of the id. Bytes without a piece have a small fixed probability. A word of over
``SHORT`` bytes is first parted wherever no piece of the vocabulary crosses, which changes
no sum, and what is still longer is summed in scaled arithmetic, byte by byte: neither
words nor pieces have a greatest length.

The result is the language of highest posterior, with that posterior as score.

Very long texts: memory follows the chunk and the longest single text; a word that can't
be parted takes some microseconds a byte.

Nulls and texts without a letter: ``und`` with score 0. Rows with null lang or null id
are never learned from; a null id counts as held out. Without a labelled row, all is
``und``. Repeated rows are scored alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, LETTER, U64, chunks, distinct, lowered, mix, prefix_hashes, released, span_hashes, spans_of, text_buffer

TRAIN_DOCS = 1500
ROUNDS = 4
#: Up to so many bytes, and the mark, products of probabilities stay within a double's range.
SHORT = 32
MARK = 1  # stands for the vocabulary's word mark
UNKNOWN = 1e-8
SMOOTH = 0.02
CHUNK = 2 << 20
#: Values of a string's bytes by place, so that equal strings have equal sums.
_PLACES = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(256)], U64)


class Pieces:
    """Piece numbers of byte strings, by two direct-mapped tables."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.n = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        data = [np.frombuffer(p, np.uint8) for p in pieces]
        self.hash = np.array([mix(np.array([(BYTE_VALUES[d] * _PLACES[: len(d)]).sum(dtype=U64)]))[0] for d in data] + [0], U64)
        self.tables = []
        left = np.arange(self.n)
        for shift in (44, 24, 4):
            slots = np.full(1 << 20, self.n, np.int32)
            at = (self.hash[left] >> U64(shift)) & U64((1 << 20) - 1)
            slots[at[::-1]] = left[::-1]
            left = left[slots[at] != left]
            self.tables.append((U64(shift), slots))
            if not len(left):
                break
        if len(left):
            raise ValueError("pieces collide")

    def find(self, sums: np.ndarray) -> np.ndarray:
        """Numbers of the strings with these sums; n where there is none."""
        h = mix(sums)
        out = np.full(len(h), self.n, np.int32)
        for shift, slots in self.tables:
            got = slots[(h >> shift) & U64((1 << 20) - 1)]
            hit = self.hash[got] == h
            out[hit] = got[hit]
        return out


def load_pieces(model_path: str) -> list[bytes]:
    """The vocabulary's pieces, as they stand."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out = []
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            piece = sp.id_to_piece(i).replace("▁", chr(MARK)).encode()
            if piece != bytes([MARK]):
                out.append(piece)
    return sorted(set(out))


def lattice(words: np.ndarray, pieces: Pieces) -> list[list[np.ndarray]]:
    """Piece numbers [end - 1][length - 1] of words of one length (rows of bytes, mark first)."""
    out = []
    width = words.shape[1]
    for end in range(1, width + 1):
        row = []
        values = BYTE_VALUES[words[:, max(0, end - pieces.longest) : end]]
        have = values.shape[1]
        for k in range(1, have + 1):
            row.append(pieces.find((values[:, have - k :] * _PLACES[:k]).sum(1, dtype=U64)))
        out.append(row)
    return out


def _table(theta: np.ndarray) -> np.ndarray:
    """Probabilities with a last row for strings that are no piece."""
    return np.vstack([theta, np.zeros((1, theta.shape[1]))])


def forward(words: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Probability of every word under every language, summed over all segmentations."""
    alpha = [np.ones((len(words), table.shape[1]))]
    for end, row in enumerate(lattice(words, pieces), 1):
        total = np.zeros_like(alpha[0])
        for k, ids in enumerate(row, 1):
            p = table[ids]
            if k == 1:
                p = np.maximum(p, UNKNOWN)
            total += alpha[end - k] * p
        alpha.append(total)
    return alpha[-1]


def expected(words: np.ndarray, weights: np.ndarray, pieces: Pieces, theta: np.ndarray) -> np.ndarray:
    """Expected piece counts over all segmentations of weighted words, for one language."""
    table = np.append(theta, 0.0)
    cells = lattice(words, pieces)
    width = words.shape[1]
    prob = [[np.maximum(table[ids], UNKNOWN) if k == 0 else table[ids] for k, ids in enumerate(row)] for row in cells]
    alpha = [np.ones(len(words))]
    for end in range(1, width + 1):
        alpha.append(sum(alpha[end - 1 - k] * p for k, p in enumerate(prob[end - 1])))
    beta = [np.zeros(len(words)) for _ in range(width)] + [np.ones(len(words))]
    counts = np.zeros(len(theta) + 1)
    scale = weights / alpha[-1]
    for end in range(width, 0, -1):
        for k, p in enumerate(prob[end - 1]):
            beta[end - 1 - k] = beta[end - 1 - k] + p * beta[end]
            counts += np.bincount(cells[end - 1][k], alpha[end - 1 - k] * p * beta[end] * scale, len(counts))
    return counts[:-1]


def _occurrences(word: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Piece numbers [end - 1, length - 1] of one string of bytes; no piece where it would start before the string."""
    n, values = len(word), BYTE_VALUES[word]
    out = np.full((n, min(pieces.longest, n)), pieces.n, np.int32)
    for k in range(1, out.shape[1] + 1):
        sums = np.zeros(n - k + 1, U64)
        for j in range(k):
            sums += values[j : j + n - k + 1] * _PLACES[j]
        out[k - 1 :, k - 1] = pieces.find(sums)
    return out


def parted(word: np.ndarray, pieces: Pieces) -> list[np.ndarray]:
    """A string's parts between places that no piece crosses: its probability is the product of theirs."""
    ends, lengths = np.nonzero(_occurrences(word, pieces) < pieces.n)
    ends, starts = ends + 1, ends - lengths
    crossed = np.zeros(len(word) + 2, np.int64)
    np.add.at(crossed, starts + 1, 1)
    np.add.at(crossed, ends, -1)
    cuts = np.flatnonzero(np.cumsum(crossed[: len(word)])[1:] == 0) + 1
    return np.split(word, cuts)


def _scaled(ids: np.ndarray, table: np.ndarray, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forward (or backward) sums of one string, for every place between its bytes: values and their log scales."""
    n, most = ids.shape
    value, scale = np.zeros((n + 1, table.shape[1])), np.zeros(n + 1)
    value[n if back else 0] = 1.0
    for at in range(n - 1, -1, -1) if back else range(1, n + 1):
        k = min(most, n - at) if back else min(most, at)
        own = ids[at + np.arange(k), np.arange(k)] if back else ids[at - 1, :k]
        near = slice(at + 1, at + 1 + k) if back else slice(at - k, at)
        p = table[own]
        p[0] = np.maximum(p[0], UNKNOWN)
        v, s = (value[near], scale[near]) if back else (value[near][::-1], scale[near][::-1])
        met = p.max(1) > 0
        top = s[met].max()
        total = (v[met] * p[met] * np.exp(s[met] - top)[:, None]).sum(0)
        most_now = total.max()
        value[at], scale[at] = total / most_now, top + np.log(most_now)
    return value, scale


def log_forward_long(word: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of one string of any length under every language."""
    value, scale = _scaled(_occurrences(word, pieces), table)
    return np.log(np.maximum(value[-1], 1e-300)) + scale[-1]


def expected_long(word: np.ndarray, weight: float, pieces: Pieces, theta: np.ndarray) -> np.ndarray:
    """expected() of one string of any length."""
    table, ids = np.append(theta, 0.0)[:, None], _occurrences(word, pieces)
    (a, sa), (b, sb) = _scaled(ids, table), _scaled(ids, table, back=True)
    counts = np.zeros(len(theta) + 1)
    for k in range(1, ids.shape[1] + 1):
        own = ids[k - 1 :, k - 1]
        p = table[own, 0]
        p = np.maximum(p, UNKNOWN) if k == 1 else p
        ends = np.arange(k, len(word) + 1)
        counts += np.bincount(own, a[ends - k, 0] * p * b[ends, 0] * np.exp(sa[ends - k] + sb[ends] - sa[-1]) * weight / a[-1, 0], len(counts))
    return counts[:-1]


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the letter runs."""
    s, e = spans_of(LETTER[raw], offsets)
    return s, e, np.searchsorted(offsets, s, "right") - 1


def _marked(raw: np.ndarray, s: int, n: int) -> np.ndarray:
    return np.concatenate([np.array([MARK], np.uint8), raw[s : s + n]])


def _by_length(raw: np.ndarray, s: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and byte rows (mark first) of words of one length, up to ``SHORT`` bytes."""
    for width in np.unique(n[n <= SHORT]).tolist():
        own = np.flatnonzero(n == width)
        rows = np.empty((len(own), width + 1), np.uint8)
        rows[:, 0] = MARK
        rows[:, 1:] = raw[s[own, None] + np.arange(width)]
        for a in range(0, len(own), 20_000):
            yield own[a : a + 20_000], rows[a : a + 20_000]


def _long_parts(raw: np.ndarray, s: np.ndarray, n: np.ndarray, pieces: Pieces) -> Iterator[tuple[bytes, list[int]]]:
    """The distinct parts of words of over ``SHORT`` bytes, and the words that have each (as often as they do)."""
    parts: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(n > SHORT).tolist():
        for part in parted(_marked(raw, int(s[i]), int(n[i])), pieces):
            parts.setdefault(part.tobytes(), []).append(i)
    yield from parts.items()


def log_words(raw: np.ndarray, s: np.ndarray, n: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of every word (start and length in raw) under every language."""
    out = np.zeros((len(s), table.shape[1]))
    for own, words in _by_length(raw, s, n):
        out[own] = np.log(forward(words, pieces, table))
    for part, owners in _long_parts(raw, s, n, pieces):
        bytes_ = np.frombuffer(part, np.uint8)
        logp = np.log(forward(bytes_[None], pieces, table))[0] if len(bytes_) <= SHORT else log_forward_long(bytes_, pieces, table)
        np.add.at(out, np.array(owners), logp)
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist())
        raw, offsets = text_buffer(batch.column(1))
        for a, b in chunks(offsets):
            part = offsets[a : b + 1] - offsets[a]
            low = lowered(raw[offsets[a] : offsets[b]])
            s, e, row = _words(low, part)
            if not len(s):
                continue
            keys = span_hashes(prefix_hashes(BYTE_VALUES[low]), s, e)
            for lang in np.unique(langs[a:b]).tolist():
                own = np.flatnonzero(langs[a:b][row] == lang)
                _, index, inverse = distinct(keys[own])
                data, n = low.tobytes(), np.bincount(inverse)
                words = [data[s[own[i]] : e[own[i]]] for i in index.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])


def fit(docs: DataFrame, model_path: str, id_col: str, text_col: str, lang_col: str, held_out) -> tuple[list[str], np.ndarray, np.ndarray, list[bytes]]:
    """Languages, piece probabilities (piece, language) and log priors. The model, not rows, reaches the driver."""
    rows = docs.where(~held_out & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    data = load_pieces(model_path)
    if not langs:
        return [], np.zeros((len(data), 0)), np.zeros(0), data
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, TRAIN_DOCS / sizes[lang]))])
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    counts = drawn.select("lang", "text").mapInArrow(released(_count_words), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = Pieces(data)
        n = pdf["word"].map(len).to_numpy()
        raw = np.frombuffer(b"".join(pdf["word"]), np.uint8)
        s, weight = np.cumsum(n) - n, pdf["n"].to_numpy(float)
        theta, long = np.full(len(data), 1.0 / len(data)), list(_long_parts(raw, s, n, pieces))
        for _ in range(ROUNDS):
            got = np.zeros(len(data))
            for own, words in _by_length(raw, s, n):
                got += expected(words, weight[own], pieces, theta)
            for part, owners in long:
                got += expected_long(np.frombuffer(part, np.uint8), weight[owners].sum(), pieces, theta)
            theta = (got + SMOOTH) / (got.sum() + SMOOTH * len(got))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "theta": [theta.tobytes()]})

    models = {r["lang"]: np.frombuffer(r["theta"]) for r in counts.groupBy("lang").applyInPandas(learn, "lang string, theta binary").collect()}
    flat = np.full(len(data), 1.0 / len(data))
    theta = np.stack([models.get(lang, flat) for lang in langs], 1)
    prior = np.log(np.array([sizes[lang] for lang in langs], float) / sum(sizes.values()))
    return langs, theta, prior, data


def identify(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; rows of fold 0 are not learned from."""
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0)) == 0
    langs, theta, prior, data = fit(docs, model_path, id_col, text_col, lang_col, held_out)
    model = docs.sparkSession.sparkContext.broadcast((theta, prior, data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta, prior, data = model.value
        pieces, table = Pieces(data), _table(theta)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(2))
            best, score = [], []
            for a, b in chunks(offsets, CHUNK):
                part = offsets[a : b + 1] - offsets[a]
                low = lowered(raw[offsets[a] : offsets[b]])
                s, e, row = _words(low, part)
                total = np.tile(prior, (b - a, 1)) if len(langs) else np.zeros((b - a, 0))
                ascii_letter = np.zeros(b - a, bool)
                if len(s) and len(langs):
                    keys, index, inverse = distinct(span_hashes(prefix_hashes(BYTE_VALUES[low]), s, e))
                    logp = log_words(low, s[index], (e - s)[index], pieces, table)
                    for k in range(len(langs)):
                        total[:, k] += np.bincount(row, logp[inverse, k], b - a)
                at = np.flatnonzero((low >= 97) & (low <= 122))
                ascii_letter[np.searchsorted(part, at, "right") - 1] = True
                for i in range(b - a):
                    known = ascii_letter[i] or any(c.isalpha() for c in low[part[i] : part[i + 1]].tobytes().decode())
                    if not known or not len(langs):
                        best.append("und")
                        score.append(0.0)
                        continue
                    k = int(np.argmax(total[i]))
                    best.append(langs[k])
                    score.append(float(1.0 / np.exp(np.maximum(total[i] - total[i, k], -700)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, held_out boolean, lang_pred string, score double")
