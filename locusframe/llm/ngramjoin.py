"""Operator 6: exact n-gram Jaccard join with set-relation skipping, and its components.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text's set is its distinct
``N``-word shingles as 64-bit hashes (a shorter text: the whole sequence as one). Equal
sets form a class; classes link when the Jaccard similarity is 75 % or more.

1. Every task sends its sets' hashes, dealt by hash range into shards, as packed byte
   strings (five bytes a hash, the range gives the rest). A shard counts the classes of
   every hash and keeps hashes of two classes or more. A class with fewer than
   ceil(3n/4) of those can link with nothing and is done.
2. The others' hashes, rarest first, are an index by prefix filter: two sets that link
   share a hash among their first n - ceil(3n/4) + 1. An entry carries its position, so
   that entries from which the needed overlap can't be reached any more are skipped, and
   its size block, so that lists are read only in blocks of possible sizes.
3. Answers of one set come first: in every list the set whose hashes are most common (its
   head, such as the text that copies were made from) is verified against the others, and
   then a second head against those that did not link. What links with a head is one
   component and skipped in the lists from then on. The others' answers derive from the
   head's: if a and b share x and y hashes with the head h, and have p and q hashes in
   common with any set but not with h, they share min(x, y) + min(p, q) at most.
4. Of what is left, the smaller set of a pair looks only into the size blocks that its
   position in the list and its answers leave open, often none; pairs of different
   components that pass all bounds are verified on the whole sets, a few for each set and
   then the rest. No link between components is lost.

Scale: shards grow with the input, lists of one component cost nothing, and joins that a
hot class skews have its rows on one side only, where AQE splits them.

Nulls and empty texts: an empty set, linked with nothing. A null doc_id keeps its row
and is nobody's smallest id. Repeated rows are copies of each other. An empty table
gives no rows. Very long texts: a text's set is made at once, in some 40 times its bytes.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_VALUES, U64, chunks, mix, prefix_hashes, released, shards_for, span_hashes, text_buffer, words_of, written
from .graph import components

N = 5
BYTES_A_SHARD = 12 << 20
FLUSH_HASHES = 1 << 21
_STEP = [U64(pow(0xA24BAED4963EE407, k, 1 << 64)) for k in range(N)]
_LOW = U64((1 << 40) - 1)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a chunk."""
    starts, ends, counts = words_of(raw, offsets)
    if not len(starts):
        return [np.zeros(0, U64)] * (len(offsets) - 1)
    hashes = span_hashes(prefix_hashes(LOWER_VALUES[raw]), starts, ends)
    m = len(hashes) - N + 1
    if m > 0:
        rolled = mix(sum((hashes[k : k + m] * _STEP[k] for k in range(N)), np.zeros(m, U64)))
    out, at = [], 0
    for n in counts.tolist():
        if n >= N:
            own = np.sort(rolled[at : at + n - N + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif n:
            out.append(np.array([U64(xxhash.xxh3_64_intdigest(hashes[at : at + n].tobytes()))]))
        else:
            out.append(np.zeros(0, U64))
        at += n
    return out


def _least(n: Column) -> Column:
    """ceil(3n/4)"""
    return F.floor((n * 3 + 3) / 4)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte runs of ``data`` as a binary array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _five(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)


def _eight(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8").astype(U64)


#: Hashes of classes; or, with ids, the texts of classes: counts says then which ids are there.
DEALT = "shard int, classes binary, sizes binary, counts binary, hashes binary, ids binary"


def _deal(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        ids: list[int] = []
        known: list[bool] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            sizes = np.array([len(s) for s in sets], np.int64)
            classes = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) for s in sets], U64)
            rows: list[tuple] = []
            of = classes % U64(shards)
            for shard in np.unique(of).tolist():
                mine = np.flatnonzero(of == shard)
                rows.append((shard, classes[mine].tobytes(), sizes[mine].astype("<u4").tobytes(), np.array(known)[mine].tobytes(), b"", np.array(ids, np.int64)[mine].tobytes()))
            # Copies need not be dealt out again.
            _, firsts = np.unique(classes, return_index=True)
            firsts = np.sort(firsts)
            flat = np.concatenate([sets[i] for i in firsts.tolist()]) if held else np.zeros(0, U64)
            owner = np.repeat(firsts, sizes[firsts])
            shard = ((flat >> U64(40)) * U64(shards)) >> U64(24)
            order = np.argsort(shard.astype(np.uint16) if shards < 65536 else shard, kind="stable")
            flat, owner = flat[order], owner[order]
            cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=U64))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[k], cuts[k + 1]
                own = owner[a:b]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                who, n = own[first], np.diff(np.append(first, b - a))
                rows.append((k, classes[who].tobytes(), sizes[who].astype("<u4").tobytes(), n.astype("<u4").tobytes(), _five(flat[a:b] & _LOW).tobytes(), b""))
            sets.clear()
            ids.clear()
            known.clear()
            held = 0
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["shard", "classes", "sizes", "counts", "hashes", "ids"])

        for batch in batches:
            own, there = batch.column(0).fill_null(0).to_pylist(), batch.column(0).is_valid().to_pylist()
            raw, offsets = text_buffer(batch.column(1))
            for a, b in chunks(offsets):
                part = offsets[a : b + 1]
                found = shingle_sets(raw[part[0] : part[-1]], part - part[0])
                sets += found
                ids += own[a:b]
                known += there[a:b]
                held += sum(map(len, found))
                if held >= FLUSH_HASHES:
                    yield flush()
        if sets:
            yield flush()

    return run


COUNTED = "doc_id long, cls long, n long, shard int, k long, hashes binary, df binary"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard: its texts (doc_id, cls, n), and of every class the hashes that other classes have too."""
    cols: dict[str, list] = {c: [] for c in ("shard", "classes", "sizes", "counts", "hashes")}
    names = [x.split()[0] for x in COUNTED.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            if row["ids"]:
                ids = np.frombuffer(row["ids"], np.int64)
                n = len(ids)
                empty = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~np.frombuffer(row["counts"], bool)), pa.array(np.frombuffer(row["classes"], np.int64)), pa.array(np.frombuffer(row["sizes"], "<u4").astype(np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), empty, empty], names=names)
            else:
                for c in cols:
                    cols[c].append(row[c])
    if not cols["shard"]:
        return
    classes = np.frombuffer(b"".join(cols["classes"]), np.int64)
    sizes = np.frombuffer(b"".join(cols["sizes"]), "<u4")
    counts = np.frombuffer(b"".join(cols["counts"]), "<u4").astype(np.int64)
    shard = np.repeat(np.array(cols["shard"], np.int64), [len(c) // 8 for c in cols["classes"]])
    hashes = _eight(b"".join(cols["hashes"]))
    del cols
    # One copy of a class in a shard is enough.
    order = np.lexsort((shard, classes))
    keep = np.ones(len(order), bool)
    keep[order[1:]] = (classes[order[1:]] != classes[order[:-1]]) | (shard[order[1:]] != shard[order[:-1]])
    flags = np.repeat(keep, counts)
    hashes, owner = hashes[flags], np.repeat(np.arange(len(counts), dtype=np.int32), counts)[flags]
    hashes |= shard[owner].astype(U64) << U64(40)
    order = np.argsort(hashes)
    ranked = hashes[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    df = np.diff(np.append(np.flatnonzero(first), len(ranked)))
    df = np.repeat(df, df)
    shared = df >= 2
    owner, hashes, df = owner[order][shared], ranked[shared], df[shared]
    del order, ranked
    order = np.argsort(owner, kind="stable")
    owner, hashes, df = owner[order], hashes[order], df[order]
    if not len(owner):
        return
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    n = np.diff(np.append(first, len(owner)))
    who = owner[first]
    for a in range(0, len(who), 20_000):
        b = min(a + 20_000, len(who))
        x, y = first[a], first[b] if b < len(who) else len(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(b - a, pa.int64()), pa.array(classes[who[a:b]]), pa.array(sizes[who[a:b]].astype(np.int64)), pa.array(shard[who[a:b]].astype(np.int32)), pa.array(n[a:b]), _binary(_five(hashes[x:y] & _LOW), n[a:b] * 5), _binary(df[x:y].astype("<u4").view(np.uint8), n[a:b] * 4)],
            names=names,
        )


SETS = "cls long, n long, others long, common double, hashes binary, prefix array<long>, p0 long, p1 long, p2 long, p3 long"
_PARITY = [f"p{k}" for k in range(4)]


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A class's shared hashes, sorted, its index entries, rarest first, and the mean number of sets of its hashes."""
    for batch in batches:
        rows: list[tuple] = []
        for row in batch.to_pylist():
            hashes = np.concatenate([_eight(p["hashes"]) | U64(p["shard"] << 40) for p in row["parts"]])
            df = np.concatenate([np.frombuffer(p["df"], "<u4") for p in row["parts"]])
            n, others = row["n"], row["n"] - len(hashes)
            length = n - -(-3 * n // 4) + 1 - others
            prefix = hashes[np.lexsort((hashes, df))[:length]]
            parity = np.packbits((np.bincount((mix(hashes) >> U64(56)).astype(np.int64), minlength=256) & 1).astype(np.uint8)).view(np.int64)
            rows.append((row["cls"], n, others, (float(df.sum()) + others) / n, np.sort(hashes).tobytes(), prefix.astype(np.int64).tolist(), *parity.tolist()))
        if rows:
            cols = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in SETS.split(", ")])


ANSWERS = "a long, b long, both long, linked boolean"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        n = np.asarray(batch.column("an")) + np.asarray(batch.column("bn"))
        shared = np.zeros(len(n), np.int64)
        for i in range(len(n)):
            both = np.concatenate([np.frombuffer(x[i].as_buffer(), U64), np.frombuffer(y[i].as_buffer(), U64)])
            both.sort()
            shared[i] = (both[1:] == both[:-1]).sum()
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared), pa.array(100 * shared >= 75 * (n - shared))], names=["a", "b", "both", "linked"])


def _entry(prefix: str, *more: str) -> list[Column]:
    """An index entry's columns under other names."""
    return [F.col(c).alias(prefix + c) for c in ("n", "i", "others", *_PARITY, *more)]


def _possible(a: str, b: str) -> Column:
    """Entries whose sets can still share three quarters of their union.

    By sizes; by what is left after their positions; and by parity: sets whose hashes
    differ in parity in k of 256 classes differ in k hashes at least, and in their
    hashes that no other set has, while (an + bn) / 7 differences are allowed.
    """
    an, bn = F.col(f"{a}n"), F.col(f"{b}n")
    left = F.least(an - F.col(f"{a}i"), bn - F.col(f"{b}i"))
    odd = sum((F.bit_count(F.col(a + p).bitwiseXOR(F.col(b + p))) for p in _PARITY), F.col(f"{a}others") + F.col(f"{b}others"))
    return (F.least(an, bn) * 4 >= F.greatest(an, bn) * 3) & (left * 7 >= (an + bn) * 3) & (odd * 7 <= an + bn)


def verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """(a, b, both, linked) of candidate pairs (a, b), counted on the whole sets."""
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("an"), F.col("hashes").alias("x"))
    b = sets.select(F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("hashes").alias("y"))
    return written(pairs.join(a, "a").join(b, "b").mapInArrow(released(_verify), ANSWERS), name)


def _heads(index: DataFrame, rank: Column) -> DataFrame:
    """The index with its list's head: the entry of least rank."""
    heads = index.groupBy("hash").agg(F.min(F.struct(rank.alias("r"), F.col("cls").alias("b"), *_entry("b"))).alias("head"))
    return index.join(heads.select("hash", "head.*").drop("r"), "hash")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root) of all classes that link with another, and the links (a, b, both) that show it."""
    index = sets.select("cls", "n", F.posexplode("prefix").alias("i", "hash"), "others", "common", *_PARITY).withColumn("i", F.col("i") + F.col("others"))
    listed = written(index.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1").select("hash"), "lists")
    index = written(index.join(listed, "hash"), "index")
    # The first heads' answers, and what follows from them for each entry: the hashes shared with the head, and the others that any set shares.
    led = written(_heads(index, F.struct(-F.col("common"), "cls")), "led")
    able = led.where((F.col("cls") != F.col("b")) & _possible("", "b")).select(F.col("cls").alias("a"), "b").distinct()
    first = verified(able, sets, "answers")
    known = led.withColumnRenamed("b", "head").drop(*[c for c in led.columns if c in {f"b{x}" for x in ("n", "i", "others", *_PARITY)}])
    known = known.join(first.select(F.col("a").alias("cls"), F.col("b").alias("head"), "both", "linked"), ["cls", "head"], "left")
    known = known.withColumn("rest", F.col("n") - F.col("others") - F.col("both"))
    known = written(known, "known")
    # Second heads, another for each list, of the entries that are not of the first head's component.
    apart = known.where(~F.coalesce("linked", F.lit(False)) & (F.col("cls") != F.col("head"))).select(*index.columns)
    able = _heads(apart, F.xxhash64("cls", "hash")).where((F.col("cls") != F.col("b")) & _possible("", "b"))
    seen = _ordered(first)
    second = verified(_ordered(able.select(F.col("cls").alias("a"), "b")).join(seen, ["a", "b"], "left_anti"), sets, "answers")
    links = first.where("linked").select("a", "b", "both").union(second.where("linked").select("a", "b", "both"))
    roots = components(links)
    seen = written(seen.union(_ordered(second)), "seen")
    rest = None
    for few in (2, None):
        if rest is None:
            rest = written(_ordered(_open_pairs(known, roots)).join(seen, ["a", "b"], "left_anti"), "rest")
        else:
            rest = _between(rest, roots).join(seen, ["a", "b"], "left_anti")
        if rest.limit(1).count() == 0:
            break
        now = rest
        if few:
            ranked = [rest.select("a", "b", F.row_number().over(Window.partitionBy(side).orderBy(F.xxhash64("a", "b"))).alias("k")) for side in ("a", "b")]
            now = ranked[0].where(F.col("k") <= few).union(ranked[1].where(F.col("k") <= few)).select("a", "b").distinct()
        more = verified(now, sets, "answers")
        seen = seen.union(more.select("a", "b"))
        new = written(more.where("linked").select("a", "b", "both"), "links")
        if new.limit(1).count():
            links = links.union(new)
            roots = components(links)
    return roots, links


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of different components."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}r"))
        pairs = pairs.join(own, side, "left").withColumn(f"{side}r", F.coalesce(f"{side}r", side))
    return pairs.where("ar <> br").select("a", "b")


def _block(n: Column) -> Column:
    """A size's block; a block's sizes differ by a fifteenth."""
    return F.floor(F.log(n) / F.log(F.lit(16 / 15)) + 1e-9)


def _open_pairs(known: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of entries that no answer, position, size or component rules out."""
    named = known.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = written(named, "named")
    lists = named.groupBy("hash").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least"), F.max(F.when(F.col("rest") > 0, 1).otherwise(F.col("rest").isNull().cast("int"))).alias("loose"))
    left = named.join(lists.where("lo <> hi").drop("lo", "hi"), "hash")
    # Sizes of sets that entry can still link with: by its position, and by its head's answer unless both have other hashes.
    by_place = F.floor((F.col("n") * 4 - F.col("i") * 7) / 3)
    by_head = F.when(F.col("both").isNotNull() & ((F.col("rest") == 0) | (F.col("loose") == 0)), F.floor(F.col("both") * 7 / 3) - F.col("n"))
    left = left.withColumn("most", F.least(F.floor(F.col("n") * 4 / 3), by_place, by_head)).where("most >= least")
    small = left.where("most >= n").select("hash", F.col("cls").alias("a"), *_entry("a", "both", "rest"), F.col("root").alias("ar"), F.explode(F.sequence(_block(F.col("n")), _block(F.col("most")))).alias("block"), F.col("most").alias("amost"))
    large = left.select("hash", F.col("cls").alias("b"), *_entry("b", "both", "rest"), F.col("root").alias("br"), _block(F.col("n")).alias("block"))
    smaller = (F.col("an") < F.col("bn")) | ((F.col("an") == F.col("bn")) & (F.col("a") < F.col("b")))
    derived = F.coalesce((F.least("aboth", "bboth") + F.least("arest", "brest")) * 7 >= (F.col("an") + F.col("bn")) * 3, F.lit(True))
    by_answers = F.col("aboth").isNull() | F.col("bboth").isNull() | derived
    return small.join(large, ["hash", "block"]).where((F.col("ar") != F.col("br")) & smaller & (F.col("bn") <= F.col("amost")) & by_answers & _possible("a", "b")).select("a", "b")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    shards = shards_for(docs, BYTES_A_SHARD)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = texts.mapInArrow(released(_deal(shards)), DEALT)
    counted = written(dealt.repartitionById(shards, "shard").mapInArrow(released(_count), COUNTED), "counted")
    members = counted.where("shard is null").select("doc_id", "cls", "n")
    parts = counted.where("shard is not null").groupBy("cls").agg(F.first("n").alias("n"), F.sum("k").alias("k"), F.collect_list(F.struct("shard", "hashes", "df")).alias("parts"))
    sets = written(parts.where(F.col("k") >= _least(F.col("n"))).select("cls", "n", "parts").mapInArrow(released(_assemble), SETS), "sets")
    roots, _ = linked_classes(sets)
    groups = members.where("n > 0").join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("doc_id", "n", F.coalesce("root", "cls").alias("g"))
    groups = written(groups, "groups")
    least = written(groups.where("doc_id is not null").groupBy("g").agg(F.min("doc_id").alias("component_id")), "least")
    found = groups.join(least, "g", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone)


#: DuckDB: the rows of join_components over documents.
ORACLE = r"""
WITH RECURSIVE ws AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM ws),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""
