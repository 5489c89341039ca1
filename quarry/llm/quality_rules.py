"""Quality rules: fixed checks and a learned decision list over document statistics.

The statistics are built-in expressions over the whole text. Words found in
repeated 3-word windows need no shuffle: the window hashes of a text, with the
position in the low bits, are sorted as one array of longs; windows whose hash
has an equal neighbour are candidates, and only those are compared as words.

The list is learned by sequential covering on labelled rows: a rule (a
conjunction of thresholds that rejects) grows by the condition of greatest
information gain on two thirds of the rows, is pruned on the rest, and is taken
if it is precise enough on both; the rows it covers leave, until no rule is
taken. The result is one ordered conditional expression. Learning reads the
statistics of at most ``max_rows`` labelled rows (the first by a hash of the
identifier) on the driver; rows that the quality classifier holds out are left
out here as well.

Only DataFrame and SQL functions. Defined cases: null text has no words, all
counts zero, and fails the base check; labels that are null do not count,
repeated labels of an identifier are averaged; without labelled rows, or with one
class, the list is empty and keeps what the base check passes. Repeated rows give
repeated rows; empty tables an empty result; extra columns are not read.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, fresh, let, quoted, text_of
from quarry.llm.quality_trees import held_out

MAX_ROWS = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = "[#*$%&|<>]+"


# ---------------------------------------------------------------- statistics

def _repeated(words: Column, n: Column) -> Column:
    """How many words lie in windows that occur twice or more in the text."""
    windows = n - F.lit(WINDOW - 1)
    bits = F.length(F.bin(windows.cast("long")))  # enough for every position

    def from_sorted(packed: Column) -> Column:
        def same(x, other):
            return F.coalesce(F.call_function("shiftright", x, bits) == F.call_function("shiftright", other, bits), F.lit(False))
        found = F.filter(packed, lambda x, k: same(x, F.get(packed, k - 1)) | same(x, F.get(packed, k + 1)))
        place = lambda x: (x - F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits)).cast("int")
        pairs = F.transform(found, lambda x: let(place(x), lambda i: F.struct(
            F.concat_ws(" ", *[F.get(words, i + d) for d in range(WINDOW)]).alias("w"), i.alias("i"))))
        return F.when(F.size(found) == 0, F.lit(0)).otherwise(let(F.sort_array(pairs), covered))

    def covered(pairs: Column) -> Column:
        def same(x, other):
            return F.coalesce(x["w"] == other["w"], F.lit(False))
        sure = F.filter(pairs, lambda x, k: same(x, F.get(pairs, k - 1)) | same(x, F.get(pairs, k + 1)))
        return let(F.sort_array(F.transform(sure, lambda x: x["i"])), lambda at: F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    packed = F.transform(F.sequence(F.lit(0), windows - 1), lambda i: F.call_function("shiftleft", F.call_function(
        "shiftright", F.xxhash64(*[F.get(words, i + d) for d in range(WINDOW)]), bits), bits) + i.cast("long"))
    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(let(F.sort_array(packed), from_sorted))


def statistics(text: Column) -> Column:
    """Struct of the counts of one text."""
    def of_words(words: Column) -> Column:
        n = F.size(words)
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
        gone = lambda chars: (F.length(text) - F.length(F.regexp_replace(text, chars, ""))).cast("long")
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            gone(SYMBOLS).alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            let(n, lambda size: _repeated(words, size)).cast("long").alias("n_repeat_words"),
            gone("[A-Z]+").alias("upper"), gone("[!?]+").alias("exclaims"), gone("[0-9]+").alias("digits"))

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)


FEATURES = ("n_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "exclaims_per_word",
            "digit_share", "words_per_line")


def features(s: Column) -> dict[str, Column]:
    per = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1))
    return {
        "n_words": s["n_words"].cast("double"), "chars_per_word": per(s["word_chars"], s["n_words"]),
        "symbols_per_word": per(s["n_symbols"], s["n_words"]), "dup_line_share": per(s["lines"]["dup"], s["lines"]["n"]),
        "repeat_share": per(s["n_repeat_words"], s["n_words"]), "upper_share": per(s["upper"], s["word_chars"]),
        "exclaims_per_word": per(s["exclaims"], s["n_words"]), "digit_share": per(s["digits"], s["word_chars"]),
        "words_per_line": per(s["n_words"], s["lines"]["n"])}


# ------------------------------------------------------------------ learning

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, f: dict[str, Column]) -> Column:
        return f[self.feature] > self.threshold if self.above else f[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def learn(rows: list[tuple[list[float], int]], names: tuple[str, ...] = FEATURES, bins: int = 48, most_rules: int = 12,
          most_conditions: int = 4, precision: float = 0.9, least: int = 5) -> list[Rule]:
    """Rules that reject, in order. ``rows``: feature values and label (1: good), in a fixed order;
    every third row prunes, the others grow."""
    cuts = []
    for f in range(len(names)):
        values = sorted({x[f] for x, _ in rows})
        step = max(1, len(values) // bins)
        cuts.append([(a + b) / 2 for a, b in zip(values, values[1:])][step // 2::step][:2 * bins])
    data = [([bisect.bisect_left(cuts[f], v) for f, v in enumerate(x)], y, k % 3 == 2) for k, (x, y) in enumerate(rows)]

    def covers(rule, b):
        return all((b[f] > c) == above for f, above, c in rule)

    def counts(rule, part):
        hit = [y for b, y in part if covers(rule, b)]
        return len(hit) - sum(hit), sum(hit)  # bad ones, good ones

    rules: list[Rule] = []
    while len(rules) < most_rules:
        grow = [(b, y) for b, y, prune in data if not prune]
        check = [(b, y) for b, y, prune in data if prune]
        rule, inside = [], grow
        while len(rule) < most_conditions:
            good = sum(y for _, y in inside)
            bad = len(inside) - good
            if not bad or not good:
                break
            now, best = math.log2(bad / len(inside)), (1e-9, None)
            for f in range(len(names)):
                size = len(cuts[f]) + 1
                hist = [[0] * size, [0] * size]
                for b, y in inside:
                    hist[y][b[f]] += 1
                below = [0, 0]
                for c in range(size - 1):
                    below = [below[0] + hist[0][c], below[1] + hist[1][c]]
                    for above, p, n in ((False, below[0], below[1]), (True, bad - below[0], good - below[1])):
                        if p >= least and (gain := p * (math.log2(p / (p + n)) - now)) > best[0]:
                            best = (gain, (f, above, c))
            if best[1] is None:
                break
            rule.append(best[1])
            inside = [x for x in inside if covers(rule[-1:], x[0])]
        if not rule:
            break

        def worth(r):
            p, n = counts(r, check)
            return (p - n) / (p + n) if p + n else -1.0

        # Shortest of the best prefixes on the rows kept for pruning.
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        p, n = counts(rule, [(b, y) for b, y, _ in data])
        q, m = counts(rule, check)
        if p < least or p < precision * (p + n) or q < precision * (q + m):
            break
        rules.append(tuple(Condition(names[f], above, cuts[f][c]) for f, above, c in rule))
        data = [x for x in data if not covers(rule, x[0])]
    return rules


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, max_rows: int) -> list[tuple[list[float], int]]:
    known = (labels.where(labels[label].isNotNull() & labels[key].isNotNull() & ~held_out(labels[key]))
             .groupBy(labels[key].cast("string").alias("key")).agg(F.avg(labels[label].cast("double")).alias("y"))
             .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    rows = docs.select(docs[key].cast("string").alias("key"), text_of(docs, text).alias("text")).join(F.broadcast(known), "key")
    rows = rows.select("key", "y", statistics(F.col("text")).alias("s"))
    rows = rows.select("key", "y", F.array(*[features(F.col("s"))[f] for f in FEATURES]).alias("x"))
    got = rows.groupBy("key").agg(F.first("y").alias("y"), F.min("x").alias("x")).orderBy(F.xxhash64("key"), "key").collect()
    return [(list(r["x"]), int(r["y"] >= 0.5)) for r in got]


def verdict(rules: list[Rule], f: dict[str, Column]) -> Column:
    """The decision list as one ordered conditional: number of the rule that rejects, 0 if none does."""
    branch = None
    for k, rule in enumerate(rules):
        every = rule[0].column(f)
        for c in rule[1:]:
            every = every & c.column(f)
        branch = F.when(every, F.lit(k + 1)) if branch is None else branch.when(every, F.lit(k + 1))
    return F.lit(0) if branch is None else branch.otherwise(F.lit(0))


def judged(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
           keep: list[str] | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """``keep`` columns (default: all), then n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, rule (that rejects; 0: none) and kept."""
    keep = list(df.columns) if keep is None else keep
    rules = learn(training_rows(df, labels, text, key, label, max_rows))
    s = fresh(df, "__stats")
    got = df.select(*[df[quoted(c)] for c in keep], statistics(text_of(df, text)).alias(s))
    f = features(F.col(s))
    failed = (F.col(s)["n_words"] < MIN_WORDS) | (100 * F.col(s)["n_repeat_words"] > MAX_REPEAT_PERCENT * F.col(s)["n_words"])
    rule = verdict(rules, f)
    named = {"n_words": F.col(s)["n_words"], "word_chars": F.col(s)["word_chars"], "n_symbols": F.col(s)["n_symbols"],
             "n_dup_lines": F.col(s)["lines"]["dup"], "n_repeat_words": F.col(s)["n_repeat_words"], "base_failed": failed,
             "rule": rule, "kept": ~failed & (rule == 0)}
    return got.select(*keep, *[c.alias(fresh(df.select(*keep), n)) for n, c in named.items()])
