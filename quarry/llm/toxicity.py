"""Toxicity: misspelled lexicon terms by Levenshtein automata, judged by their context.

The lexicon is learned from labelled texts: whole words, and stems (a word's first letters,
whatever follows), whose share of toxic texts is far over the base rate. It is a trie. A
token's Levenshtein automaton (one bit set of token positions for each number of edits) walks
down the trie, so that all terms within the allowed edits are found in one descent; a whole
term must use up the token, a stem may leave a rest. Most tokens are settled before: of a term
cut into one part more than the edits allowed, some part must stand in the token unedited.

Every hit is then seen in a window of tokens around it. Quotation marks around it, verbs of
reporting and words about words speak for quotation; the second person speaks for abuse. The
document's score is a logistic function of its abusive and quoted hits, how many, how dense and how
exact they are, learned from hits of lexica that did not see the document (by folds).

Training reads at most ``MAX_TRAINING_ROWS`` labelled rows (the first by a hash of the
identifier), near copies among them once; counting is Spark's, the driver gets the
``MAX_TERMS`` best terms and a few numbers per training row. Labels, language, source and identifier
are no inputs of a score. Defined cases: null and empty texts are scored like any other (no
hits); null labels are left out, repeated labels of an identifier averaged; rows with a null
identifier are never training rows and not held out. Without labelled rows of both classes
the score is the labels' rate everywhere (0.5 without any). Empty tables give empty results; repeated
rows score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from quarry.llm.common import fresh, in_arrow, named, text_of

MAX_TRAINING_ROWS, MAX_TERMS = 20_000, 2_000
THRESHOLD = 0.7
HELD_OUT_OF, HELD_OUT_AT = 3, 1
STEMS = (4, 5, 6, 7)            # letters of a stem
LEAST_TEXTS, LEAST_EVIDENCE = 3, 15.0
FOLDS = 5
SURE = 0.7                      # weight from which a term may be misspelled
WINDOW = 8                      # tokens on each side
LONGEST_TOKEN = 64              # longer ones are no misspelled terms: only exact terms and stems of them count
HELD_TERMS, HELD_TOKENS = 200_000, 800_000

# Letters and digits; signs that stand in for letters only between them.
TOKEN = re.compile(r"[^\W_]+(?:[*@$]+[^\W_]+)*")
MARKS = "\"'“”„‟«»‹›‘’‚"
# Fixed words of the context score.
REPORTING = frozenset("""said says say saying wrote writes write written called calls call calling quoted quotes quote quoting replied
    shouted yelled claimed term terms word words slur slurs insult insults phrase sagte sagt schrieb nannte wort dit disait écrit mot
    dijo dice escribió palabra llamó""".split())
DIRECT = frozenset("you your youre yourself u ur du dich dir dein deine ihr euch tu te toi vous ton ta eres tú usted ustedes".split())


# ------------------------------------------------------------------ lexicon

def allowed(length: int, weight: float) -> int:
    """Edits that a term may be off; short and weakly supported terms are near too many words."""
    return 0 if length < 5 or weight < SURE else 1 if length < 9 else 2


@dataclass
class Lexicon:
    """Terms with weights; a stem is written with a final ``*``. Built once, then only read."""

    weights: dict[str, float]
    trie: list = field(default_factory=list)   # node: (children, term or None, stem or None)
    parts: dict = field(default_factory=dict)  # by the token's letters: places (start, end) and the unedited parts that may stand there
    memo: dict = field(default_factory=dict)
    settled: set = field(default_factory=set)

    def __post_init__(self):
        self.trie = [({}, None, None)]
        for term in self.weights:
            at, text, stem = 0, term.rstrip("*"), term.endswith("*")
            for c in text:
                if c not in self.trie[at][0]:
                    self.trie[at][0][c] = len(self.trie)
                    self.trie.append(({}, None, None))
                at = self.trie[at][0][c]
            children, whole, begun = self.trie[at]
            self.trie[at] = (children, whole if stem else term, term if stem else begun)

    def parts_in(self, n: int) -> list[tuple[int, int, set[str]]]:
        """Of every term that a token of ``n`` letters may be: the term's parts, one more than the edits
        allowed, at each place that so many edits can shift them to."""
        if n not in self.parts:
            out: dict[tuple[int, int], set[str]] = {}
            for term, weight in self.weights.items():
                text = term.rstrip("*")
                k = allowed(len(text), weight)
                if n < len(text) - k or (text == term and n > len(text) + k):
                    continue
                cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
                for start, end in zip(cuts, cuts[1:], strict=False):
                    for shift in range(max(-k, -start), k + 1):
                        out.setdefault((start + shift, end + shift), set()).add(text[start:end])
            self.parts[n] = [(*place, texts) for place, texts in out.items()]
        return self.parts[n]

    def descend(self, token: str) -> list[tuple[str, int]]:
        """Terms within their allowed edits of the token, and the edits needed."""
        n, most = len(token), 2
        places: dict[str, int] = {}
        for i, c in enumerate(token):
            places[c] = places.get(c, 0) | 1 << i
        end, full = 1 << n, (2 << n) - 1
        first, state = [], 1
        for _ in range(most + 1):     # after e edits: e letters of the token may be skipped
            first.append(state)
            state |= state << 1 & full
        out, todo = [], [(0, tuple(first), 0)]
        while todo:
            node, rows, depth = todo.pop()
            children, whole, stem = self.trie[node]
            if whole is not None:
                e = next((e for e in range(allowed(depth, self.weights[whole]) + 1) if rows[e] & end), None)
                if e is not None:
                    out.append((whole, e))
            if stem is not None:
                e = next((e for e in range(allowed(depth, self.weights[stem]) + 1) if rows[e]), None)
                if e is not None:
                    out.append((stem, e))
            for c, child in children.items():
                at = places.get(c, 0)
                new, before = [], 0
                for e in range(most + 1):
                    row = (rows[e] & at) << 1
                    if e:
                        # a letter of the term left out, replaced, or one of the token too many
                        row |= rows[e - 1] | rows[e - 1] << 1 & full | before << 1 & full
                    new.append(row)
                    before = row
                if new[most]:
                    todo.append((child, tuple(new), depth + 1))
        return out

    def exact(self, token: str) -> list[tuple[str, int]]:
        return [(t, 0) for t in (token, *(token[:k] + "*" for k in range(1, LONGEST_TOKEN))) if t in self.weights]

    def look_up(self, token: str) -> tuple[str, int] | None:
        """The best term for a token: fewest edits, then weight."""
        if len(token) > LONGEST_TOKEN:
            found = self.exact(token)
        else:
            for start, end, texts in self.parts.get(len(token)) or self.parts_in(len(token)):
                if token[start:end] in texts:
                    break
            else:
                return None
            found = self.descend(token)
        return min(found, key=lambda f: (f[1], -self.weights[f[0]], f[0]), default=None)

    def hits_among(self, tokens: set[str]) -> dict[str, tuple[str, int]]:
        """The tokens that hit, memoised for this worker."""
        new = tokens - self.settled
        if new:
            if len(self.settled) > HELD_TOKENS:
                self.settled.clear()
                self.memo.clear()
                new = tokens
            for t in new:
                if hit := self.look_up(t):
                    self.memo[t] = hit
            self.settled |= new
        return {t: self.memo[t] for t in tokens & self.memo.keys()}


# ------------------------------------------------------------------ context

def quotation(text: str, spans: list[tuple[int, int]], words: list[str], at: int) -> float:
    """0 (meant) to 1 (quoted) for the token ``at``, from its window."""
    low, high = max(0, at - WINDOW), min(len(spans), at + WINDOW + 1)
    start, end = spans[at]
    before, after = text[spans[low][0]:start], text[end:spans[high - 1][1] + 1]
    score = 0.0
    # A mark opens before the token and one closes after it, not the apostrophe inside a word.
    opens = sum(1 for i, c in enumerate(before) if c in MARKS and not (0 < i < len(before) - 1 and before[i - 1].isalnum() and before[i + 1].isalnum()))
    closes = sum(1 for i, c in enumerate(after) if c in MARKS and not (0 < i < len(after) - 1 and after[i - 1].isalnum() and after[i + 1].isalnum()))
    if opens and closes:
        score += 0.6
    near = words[low:at] + words[at + 1:high]
    score += 0.3 * any(w in REPORTING for w in near)
    score -= 0.3 * any(w in DIRECT for w in near)
    return min(max(score, 0.0), 1.0)


FEATURES = ("exact", "inexact", "worst", "density", "terms", "quoted")
SIGNED = 5  # the features before this one can only speak for label 1


HITS = ArrayType(StructType().add("start", IntegerType()).add("end", IntegerType()).add("term", StringType())
                 .add("edits", IntegerType()).add("quoted", DoubleType()))


def lowered(text: str) -> str:
    """Lower case without a change of length: a letter that has no single lower one stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def scan(text: str, lexicon: Lexicon) -> tuple[list[tuple[int, int, str, int, float]], int]:
    """Start, end, term, edits and quotation score of every hit, and the number of tokens."""
    low = lowered(text)
    words = TOKEN.findall(low)
    found = lexicon.hits_among(set(words))
    if not found:
        return [], len(words)
    spans, end = [], 0
    for w in words:  # nothing of a token's letters stands between it and the one before
        start = low.index(w, end)
        end = start + len(w)
        spans.append((start, end))
    return [(*spans[i], *found[w], quotation(low, spans, words, i)) for i, w in enumerate(words) if w in found], len(words)


def measures(got: list[tuple[int, int, str, int, float]], tokens: int, lexicon: Lexicon) -> list[float]:
    """The ``FEATURES`` of a text with these hits."""
    if not got:
        return [0.0] * len(FEATURES)
    strength = [lexicon.weights[t] * 0.6 ** e for _, _, t, e, _ in got]
    meant = [s * (1 - q) for s, (*_, q) in zip(strength, got, strict=True)]
    exact = [m for m, h in zip(meant, got, strict=True) if not h[3]]
    return [float(np.log1p(sum(exact))), float(np.log1p(sum(meant) - sum(exact))), max(meant),
            float(np.log1p(100 * sum(meant) / tokens)), float(np.log1p(len({h[2] for h in got}))),
            float(np.log1p(sum(strength) - sum(meant)))]


def hits(text: str, lexicon: Lexicon) -> list[tuple[int, int, str, int, float]]:
    return scan(text, lexicon)[0]


def features(text: str, lexicon: Lexicon) -> list[float]:
    return measures(*scan(text, lexicon), lexicon)


# ----------------------------------------------------------------- training

@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Newton's method; a feature before ``SIGNED`` that would count against label 1 is left out."""
    used = list(range(x.shape[1]))
    while True:
        w, bias = _newton(x[:, used], y, ridge)
        worst = min((v, i) for v, i in [(0.0, -1), *((float(v), i) for v, i in zip(w, used, strict=True) if i < SIGNED)])
        if worst[0] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out, bias
        used.remove(worst[1])


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    z, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def chosen(counts: list[tuple[str, int, int]], toxic: int, clean: int, most: int = MAX_TERMS) -> dict[str, float]:
    """Terms by evidence, from their numbers of toxic and clean texts: a stem where it covers more
    texts than its words do, else the word; weights are log odds over the base rate, from 0 to 1."""
    if not toxic or not clean:
        return {}
    base = toxic / (toxic + clean)
    found = []
    for term, a, b in counts:
        if a < LEAST_TEXTS or a / (a + b) <= base:
            continue
        share = a / (a + b)
        evidence = 2 * (a * np.log(share / base) + (b * np.log((1 - share) / (1 - base)) if b else 0))
        if evidence >= LEAST_EVIDENCE and share >= min(0.8, (1 + base) / 2):
            odds = np.log((a + 0.5) / (b + 0.5) * (clean + 1) / (toxic + 1))
            found.append((a - b, not term.endswith("*"), len(term), term, min(1.0, max(0.05, float(odds) / 6))))
    found.sort(key=lambda f: (-f[0], not f[1], -f[2], f[3]))
    out: dict[str, float] = {}
    within: dict[str, int] = {}  # first letters of chosen terms: most texts that such a term covers
    for covers, whole, _, term, weight in found:
        text = term.rstrip("*")
        if len(out) == most:
            break
        if any(text[:k] + "*" in out for k in range(1, len(text) + 1)) or not whole and covers <= within.get(text, 0):
            continue
        out[term] = weight
        for k in range(1, len(text) + 1):
            within[text[:k]] = max(covers, within.get(text[:k], 0))
    return out


def terms_of(text: str) -> set[str]:
    words = {w for w in TOKEN.findall(lowered(text)) if 3 <= len(w) <= LONGEST_TOKEN}
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT_AT, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, max_rows: int) -> DataFrame:
    """``key``, ``y``, ``text``, ``fold`` and ``sketch`` (equal for copies, mostly for near copies) of the training rows."""
    name = labels[key].cast("string")
    known = (labels.where(labels[label].isNotNull() & labels[key].isNotNull() & ~held_out(labels[key]))
             .groupBy(name.alias("key")).agg(F.avg(labels[label].cast("double")).alias("y"))
             .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    rows = docs.select(named(key).cast("string").alias("key"), text_of(docs, text).alias("text"))
    words = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    return (rows.join(F.broadcast(known), "key").withColumn("sketch", F.array_min(pairs))
            .withColumn("fold", F.pmod(F.xxhash64("sketch"), F.lit(FOLDS)).cast("int")))


def _counted(sample: DataFrame) -> DataFrame:
    """Texts with each term (null: all texts) by class and fold: ``t0``, ``c0``, ``t1``, ``c1``, ..."""
    columns = [f"{side}{f}" for f in range(FOLDS) for side in "tc"]

    def batches(it):
        held: Counter = Counter()

        def given():
            terms = sorted({t for t, _ in held}, key=lambda t: (t is not None, t))
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([held[t, i] for t in terms], pa.int64()) for i in range(len(columns)))], names=["term", *columns])

        for batch in it:
            for y, fold, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = 2 * fold + (0 if y >= 0.5 else 1)
                held.update((t, at) for t in terms_of(text))
                held[None, at] += 1
                if len(held) > HELD_TERMS:
                    yield given()
                    held.clear()
        if held:
            yield given()

    parts = in_arrow(sample.select("y", "fold", "text"), batches, "term string, " + ", ".join(f"{c} long" for c in columns))
    return parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).withColumns(
        {side: sum(F.col(f"{side}{f}") for f in range(FOLDS)) for side in "tc"})


def _measured(sample: DataFrame, lexica: list[Lexicon]) -> DataFrame:
    """``key``, ``y`` and features by the lexicon that did not see the row's fold."""
    def batches(it):
        for batch in it:
            x = [features(t, lexica[f]) for f, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["key", "y", "x"])

    return in_arrow(sample.select("key", "y", "fold", "text"), batches, "key string, y double, x array<double>")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          max_rows: int = MAX_TRAINING_ROWS, max_terms: int = MAX_TERMS) -> Model:
    sample = _sample(docs, labels, text, key, label, max_rows)
    # Of texts with one sketch the first stays, and of an identifier's rows one: copies are no further evidence.
    once = (sample.groupBy("sketch", (F.col("y") >= 0.5).alias("side")).agg(F.min(F.struct("key", "y", "fold", "text")).alias("r")).select("r.*"))
    counts = (_counted(once).where(f"term IS NULL OR (t >= {LEAST_TEXTS} AND t > c)")
              .orderBy(F.col("term").isNotNull(), F.expr("c - t"), "term").limit(20 * max_terms).collect())
    total = counts[0] if counts and counts[0]["term"] is None else None
    toxic, clean = (total["t"], total["c"]) if total else (0, 0)
    if not toxic or not clean:
        rate = 0.5 if not toxic + clean else toxic / (toxic + clean)
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Model(Lexicon({}), np.zeros(len(FEATURES)), float(np.log(rate / (1 - rate))))
    terms = [r for r in counts if r["term"] is not None]

    def lexicon(f: int | None) -> Lexicon:
        """From all folds but one (None: from all)."""
        rest = [(r["term"], r["t"] - (r[f"t{f}"] if f is not None else 0), r["c"] - (r[f"c{f}"] if f is not None else 0)) for r in [total, *terms]]
        return Lexicon(chosen(rest[1:], rest[0][1], rest[0][2], max_terms))

    other = [lexicon(f) for f in range(FOLDS)]
    got = sorted(_measured(once, other).collect(), key=lambda r: r["key"])
    weights, bias = logistic(np.array([r["x"] for r in got]), (np.array([r["y"] for r in got]) >= 0.5).astype(float))
    return Model(lexicon(None), weights, bias)


def scored(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), then ``score``, the probability of label 1, and ``hits``:
    start and end in code points, the term, edits and how much the context speaks for quotation."""
    keep = list(df.columns) if keep is None else keep
    names = [fresh(df, "score"), fresh(df, "hits")]
    src = df.select(*[named(c) for c in keep], text_of(df, text).alias(fresh(df, "__text")))
    kind = df.select(*[named(c) for c in keep]).schema.add(names[0], "double").add(names[1], HITS)

    def batches(it):
        arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.float64())]))
        for batch in it:
            texts = batch.column(len(keep)).to_pylist()
            seen = [scan(t, model.lexicon) for t in texts]
            x = np.array([measures(*s, model.lexicon) for s in seen]).reshape(len(texts), len(FEATURES))
            found = [[dict(zip(("start", "end", "term", "edits", "quoted"), h, strict=True)) for h in s[0]] for s in seen]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(model.score(x)), pa.array(found, arrow)], names=[f.name for f in kind])

    return in_arrow(src, batches, kind)
