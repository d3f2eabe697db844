"""Operator 13: quality rules as a learned decision list (DataFrame functions only).

Every text gets a row of statistics. A decision list of threshold conjunctions is learned
from the labelled texts that pass the base rules; a text that one of its rules covers is
rejected, with the rule's number.

How: sequential covering. A rule grows on two thirds of the labelled rows by the threshold
of greatest information gain, one after the other, until it covers no good row; it is then
pruned to those of its first conditions for which (bad - good) / (bad + good) is greatest
on the other third, and accepted if it is precise enough there. Rows it covers are taken
off, and the next rule grows, until none is worth accepting. Candidate thresholds are
quantiles of both classes. Each step is one aggregation of counts by (statistic, bin,
label) with a map-side combine; the driver gets these counts only, so all labelled rows
count and none is collected. The list is emitted as one conditional expression.

Base rules and counts are exact but for one thing: words and windows of five words are
compared by 64-bit hashes within a text.

Definitions: words are runs other than white space (bytes 9-13 and 32). A null text has no
words and fails the base rules, as does an empty one. Ratios of nothing are 0. Labels
other than 0 and 1, null included, and null ids teach nothing; an id with several labels
has its least one. Without labels there are no rules, and what passes the base is kept.
Repeated rows are judged each on its own, alike. Very long texts: every step is linear in
the text but for sorting its windows, which only texts with repeated windows do. Other
columns are carried along whatever their names, but for the statistics, ``base_failed``,
``rule`` and ``kept``, which are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, own_names, written

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20
#: Candidate thresholds of a statistic, for each label.
CUTS = 48
MOST_CONDITIONS = 4
MOST_RULES = 12
#: Bad rows that a rule must cover on the growing and on the pruning rows, and its least precision there.
LEAST_COVERED = 5
LEAST_PRECISION = 0.9
_BLANK = r"[ \t-\r]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that rules may ask for, with the number of words.
RATIOS = ("mean_word", "symbol_ratio", "upper_ratio", "mark_ratio", "distinct_ratio", "dup_line_ratio", "repeat_ratio", "words_a_line")
FEATURES = ("n_words", *RATIOS)


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with COUNTS and RATIOS of its texts."""
    docs = docs.drop(*COUNTS, *RATIOS)
    own = [F.col(f"`{c}`") for c in docs.columns]
    text, words, hashes, windows, sums, lines, ranked = own_names(docs, "__text", "__words", "__hashes", "__windows", "__sums", "__lines", "__ranked")
    c = F.col
    df = docs.withColumn(text, F.coalesce(c(text_col), F.lit("")))
    df = df.withColumn(words, F.filter(F.split(text, f"{_BLANK}+"), lambda w: w != ""))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(windows, F.transform(starts, lambda i: F.xxhash64(*[F.get(c(hashes), i + k) for k in range(WINDOW)])))
    df = df.withColumn(lines, F.transform(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")), lambda x: F.xxhash64(x)))
    # (hash, place) of all windows, in order, where some window is repeated.
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    pairs = F.transform(c(windows), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.withColumn(ranked, F.when(repeated, F.sort_array(pairs)))
    same = lambda x, other: F.coalesce(x["h"] == F.get(c(ranked), other)["h"], F.lit(False))
    twice = F.filter(c(ranked), lambda x, k: same(x, k - 1) | same(x, k + 1))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(places, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")))["n"]
    letters = F.length(F.array_join(words, ""))
    distinct = F.size(F.array_distinct(hashes))
    number = lambda x: x.cast("long")
    size = F.length(text)
    df = df.withColumn(sums, F.struct(
        number(F.size(words)).alias("n_words"),
        number(letters).alias("word_chars"),
        number(size - _without(c(text), r"[#*$%&|<>]")).alias("n_symbols"),
        number(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        number(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        number(F.size(lines)).alias("lines"),
        number(size - _without(c(text), r"[A-Z]")).alias("upper"),
        number(size - _without(c(text), r"[!-/:-@\[-`{-~]")).alias("marks"),
        number(distinct).alias("distinct"),
    ))
    of = lambda name: c(sums)[name]
    ratios = {
        "mean_word": (of("word_chars"), of("n_words")),
        "symbol_ratio": (of("n_symbols"), of("word_chars")),
        "upper_ratio": (of("upper"), of("word_chars")),
        "mark_ratio": (of("marks"), of("word_chars")),
        "distinct_ratio": (of("distinct"), of("n_words")),
        "dup_line_ratio": (of("n_dup_lines"), of("lines")),
        "repeat_ratio": (of("n_repeat_words"), of("n_words")),
        "words_a_line": (of("n_words"), of("lines")),
    }
    return df.select(*own, *[of(n).alias(n) for n in COUNTS], *[_ratio(*ratios[n]).alias(n) for n in RATIOS])


def base_failed(least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    """Too few words, or too many of them in repeated windows (percent)."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """A statistic at least, or below, a threshold."""

    name: str
    least: bool
    at: float

    def column(self) -> Column:
        return F.col(self.name) >= F.lit(self.at) if self.least else F.col(self.name) < F.lit(self.at)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.least else '<'} {self.at!r}"


Rule = tuple[Condition, ...]


def all_of(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    """Information gain of narrowing a rule to (bad, good)."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _bin(values: list[float], name: str) -> Column:
    """How many of the sorted cuts a statistic reaches."""
    return F.size(F.filter(F.array(*[F.lit(float(v)) for v in values]), lambda v: v <= F.col(name))) if values else F.lit(0)


def _best(found: list, cuts: dict[str, list[float]]) -> tuple[float, Condition, int, int] | None:
    """The condition of greatest gain by counts (name, bin, bad, good); ties: first statistic, least threshold."""
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for r in found:
        by.setdefault(r["name"], {})[r["bin"]] = (r["bad"], r["good"])
    best = None
    for name in FEATURES:
        bins = by.get(name, {})
        bad_all, good_all = sum(b for b, _ in bins.values()), sum(g for _, g in bins.values())
        if not bad_all:
            continue
        below_bad = below_good = 0
        for k, cut in enumerate(cuts[name]):
            bad, good = bins.get(k, (0, 0))
            below_bad, below_good = below_bad + bad, below_good + good
            for least, b, g in ((True, bad_all - below_bad, good_all - below_good), (False, below_bad, below_good)):
                gain = _gain(b, g, bad_all, good_all)
                if gain > 1e-9 and b >= LEAST_COVERED and (best is None or gain > best[0] + 1e-9):
                    best = (gain, Condition(name, least, cut), b, g)
    return best


def learn(labelled: DataFrame, conditions: int = MOST_CONDITIONS, rules: int = MOST_RULES, precision: float = LEAST_PRECISION) -> list[Rule]:
    """A decision list from (FEATURES, label, grow): rules that cover rows of label 0.

    ``labelled`` is read once for every step; pass a written table.
    """
    parts = [i / CUTS for i in range(1, CUTS)]
    asked = [F.percentile_approx(n, parts, 20 * CUTS).alias(n) for n in FEATURES]
    found = [labelled.where(F.col("grow") & (F.col("label") == label)).agg(*asked).first() for label in (0, 1)]
    cuts = {n: sorted({v for row in found if row[n] for v in row[n]}) for n in FEATURES}
    spread = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), _bin(cuts[n], n).alias("bin")) for n in FEATURES]))
    bad, good = F.sum((F.col("label") == 0).cast("long")), F.sum((F.col("label") == 1).cast("long"))
    out: list[Rule] = []
    left = labelled
    while len(out) < rules:
        rule: Rule = ()
        while len(rule) < conditions:
            counts = left.where(F.col("grow") & all_of(rule)).select("label", spread.alias("x")).groupBy("x.name", "x.bin").agg(bad.alias("bad"), good.alias("good"))
            best = _best(counts.collect(), cuts)
            if best is None:
                break
            rule += (best[1],)
            if best[3] == 0:
                break
        if not rule:
            break
        tallies = [x for k in range(1, len(rule) + 1) for x in (F.sum((all_of(rule[:k]) & (F.col("label") == 0)).cast("long")).alias(f"bad{k}"), F.sum((all_of(rule[:k]) & (F.col("label") == 1)).cast("long")).alias(f"good{k}"))]
        held = left.where(~F.col("grow")).agg(*tallies).first()
        tally = [(held[f"bad{k}"] or 0, held[f"good{k}"] or 0) for k in range(1, len(rule) + 1)]
        worth = lambda t: (t[0] - t[1]) / (t[0] + t[1]) if t[0] + t[1] else -1.0
        keep = max(range(len(rule)), key=lambda k: (worth(tally[k]), -k))
        if tally[keep][0] < LEAST_COVERED or tally[keep][0] < precision * sum(tally[keep]):
            break
        out.append(rule[: keep + 1])
        left = left.where(~all_of(out[-1]))
    return out


def fired(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that covers a row, as one ordered conditional expression; else null."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(all_of(rules[0]), F.lit(1))
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(all_of(rule), F.lit(k))
    return out


def written_rules(rules: list[Rule]) -> str:
    """The list as SQL text."""
    whens = " ".join(f"WHEN {' AND '.join(map(str, rule))} THEN {k}" for k, rule in enumerate(rules, 1))
    return f"CASE {whens} END" if rules else "NULL"


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", teaches: Column | None = None) -> tuple[DataFrame, list[Rule]]:
    """docs without its text, with statistics, base_failed, rule and kept; and the list.

    ``teaches`` (of the column ``id``) narrows the labelled rows that are learned from, to
    measure the list on the others.
    """
    docs = docs.drop("base_failed", "rule", "kept")
    stats = written(with_statistics(docs, text_col).drop(text_col), "statistics")
    known = labels.where(F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(label_id).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    if teaches is not None:
        known = known.where(teaches)
    rows = stats.where(~base_failed()).select(F.col(f"`{id_col}`").alias("id"), *FEATURES).join(broadcast_if_small(known), "id")
    grow = F.crc32(F.concat(F.lit("grow"), F.col("id").cast("string"))) % 3 != 0
    rules = learn(written(rows.select(*FEATURES, "label", grow.alias("grow")), "labelled"))
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", fired(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
