"""Spelling variant grouping: generated edits probed against Bloom filters of the vocabulary.

Words are counted per task, then by Spark. The vocabulary is sharded by word length,
each shard a blocked Bloom filter (blocks of 512 bits, one memory line per probe).
Every word generates its neighbours that come first in one fixed direction: each deletion of a
letter and each replacement by a letter of higher code point, so that of two near words
exactly one generates the other. Hashes are polynomial, so an edit's hash follows from the
word's in a few vector operations, without its text; only edits that pass their length's filter
are written out, and an exact join with the vocabulary removes those that are no words.

The filters of one pass hold at most ``MAX_FILTER_BYTES``, which is what is broadcast; a larger
vocabulary takes several passes, each over the words of one slice of the hashes. No limit
on candidates, neighbours or word length: the result is exact whatever the filters let through.

A word's form is its most frequent neighbour, if at least ``LEAST_RATIO`` times as
frequent; counts grow along a chain of forms, so chains end, and roots come from
doubling joins. Defined cases: null texts have no words, a null identifier is written as
nothing before the colon; runs of any length, repeated rows count as often as they stand;
among equally frequent neighbours the smallest word in code-point order is the form. Empty
tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow, named
from quarry.operators.staging import stage

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lowered
SHORTEST, FEWEST, LEAST_RATIO = 5, 3, 2
SLIP = 97                     # one run in so many loses a letter
MAX_FILTER_BYTES = 32 << 20   # of one pass
BITS, LONG_BITS = 16, 64      # of filter for each word; for words of over LONG letters
LONG, PROBED_BITS, LEAST_BLOCKS = 64, 6, 16
HELD_WORDS, HELD_LETTERS = 100_000, 8 << 20
PROBES = 1 << 20              # edits tested at once

# Odd multiplier of the polynomial hash, its inverse modulo 2^64, and multipliers of the final mix.
P = 0x9E3779B97F4A7C15
P_BACK = pow(P, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# --------------------------------------------------------------- vocabulary

def counted(keys: list, texts: list[str]) -> Counter:
    """Counts of the words of lowered texts, slips applied."""
    out: Counter = Counter()
    for key, text in zip(keys, texts, strict=True):
        start = zlib.crc32(f"{'' if key is None else key}:".encode())
        for run, n in Counter(RUN.findall(text)).items():
            if len(run) < SHORTEST:
                continue
            h = zlib.crc32(run.encode(), start)
            if h % SLIP == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
                if len(run) < SHORTEST:
                    continue
            out[run] += n
    return out


def vocabulary(df: DataFrame, text: str = "text", key: str = "doc_id", fewest: int = FEWEST) -> DataFrame:
    """``word``, ``n`` for the words found at least ``fewest`` times."""
    def batches(it):
        held: Counter = Counter()
        letters = 0

        def given():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in it:
            lowered = pc.ascii_lower(pc.fill_null(batch.column(1), ""))
            for at in range(0, batch.num_rows, 64):
                now = counted(batch.column(0)[at:at + 64].to_pylist(), lowered[at:at + 64].to_pylist())
                letters += sum(len(w) for w in now.keys() - held.keys())
                held.update(now)
                if len(held) > HELD_WORDS or letters > HELD_LETTERS:
                    yield given()
                    held.clear()
                    letters = 0
        if held:
            yield given()

    src = df.select(named(key).cast("string").alias("key"), named(text).cast("string").alias("text"))
    return in_arrow(src, batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# ------------------------------------------------------------------ filters

def shard(lengths: np.ndarray) -> np.ndarray:
    """One shard for every length up to LONG, beyond it one for each doubling."""
    return np.where(lengths <= LONG, lengths, LONG + np.ceil(np.log2(np.maximum(lengths, 1)))).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def powers(count: int) -> np.ndarray:
    out = np.full(max(count, 1), np.uint64(P))
    out[0] = 1
    return np.multiply.accumulate(out)[:count]


def grouped(words: list[str]):
    """Row numbers and code points [word, position] for the words of each length."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        codes = np.frombuffer("".join([words[r] for r in rows]).encode("utf-32-le"), dtype=np.uint32).reshape(len(rows), length)
        yield rows, codes.astype(np.uint64)


@dataclass
class Layout:
    """Where the blocks of each shard lie, and into how many passes the words are cut."""

    first: np.ndarray   # by shard
    blocks: np.ndarray  # by shard; 0: no words
    slices: int

    @property
    def total(self) -> int:
        return int(self.blocks.sum())

    @classmethod
    def of(cls, words: dict[int, int], max_bytes: int = MAX_FILTER_BYTES) -> Layout:
        """``words``: their number by shard."""
        need = {s: n * (BITS if s <= LONG else LONG_BITS) / 512 for s, n in words.items()}
        slices = max(1, -(-int(64 * sum(need.values())) // max_bytes))
        blocks = np.zeros(max(words, default=0) + 1, dtype=np.int64)
        for s, n in need.items():
            blocks[s] = max(LEAST_BLOCKS, int(np.ceil(n / slices)))
        return cls(np.cumsum(blocks) - blocks, blocks, slices)

    def place(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block, slice and the hash whose bits are probed, for hashes of words of one length."""
        s = int(shard(np.array([length]))[0])
        z = mixed(h + np.uint64(length))
        block = self.first[s] + ((z >> np.uint64(32)) * np.uint64(self.blocks[s]) >> np.uint64(32)).astype(np.int64)
        return block, (z % np.uint64(self.slices)).astype(np.int64), mixed(z ^ np.uint64(P))

    def has(self, length: int) -> bool:
        s = int(shard(np.array([length]))[0])
        return s < len(self.blocks) and self.blocks[s] > 0


def _bit(z: np.ndarray, k: int) -> np.ndarray:
    return z >> np.uint64(9 * k) & np.uint64(511)


def filter_blocks(words: DataFrame, layout: Layout, part: int) -> DataFrame:
    """Blocks of one pass's filters: ``block``, ``b0`` .. ``b7``."""
    def batches(it):
        for batch in it:
            for _, codes in grouped(batch.column(0).to_pylist()):
                block, piece, z = layout.place((codes * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64), codes.shape[1])
                mine = piece == part
                lines = np.zeros((int(mine.sum()), 8), dtype=np.uint64)
                for k in range(PROBED_BITS):
                    bit = _bit(z[mine], k)
                    lines[np.arange(len(lines)), bit >> np.uint64(6)] |= np.uint64(1) << (bit & np.uint64(63))
                yield pa.RecordBatch.from_arrays([pa.array(block[mine]), *(pa.array(lines[:, i].view(np.int64)) for i in range(8))],
                                                 names=["block", *(f"b{i}" for i in range(8))])

    lines = ", ".join(f"b{i} long" for i in range(8))
    return in_arrow(words.select("word"), batches, f"block long, {lines}").groupBy("block").agg(
        *[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(8)])


def passed(bits: np.ndarray, block: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Which probes find all their bits set; each bit is only looked up for the probes still in."""
    left = np.arange(len(block))
    for k in range(PROBED_BITS):
        bit = _bit(z[left], k)
        line = bits[block[left] * 8 + (bit >> np.uint64(6)).astype(np.int64)]
        left = left[(line >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return left


# -------------------------------------------------------------------- edits

def edits(codes: np.ndarray, alphabet: np.ndarray, layout: Layout, bits: np.ndarray, part: int):
    """Edits of words of one length that pass: word numbers, positions and the new letter (0: deleted)."""
    n, length = codes.shape
    power = powers(length)
    terms = codes * power
    whole = terms.sum(axis=1, dtype=np.uint64)
    if layout.has(length - 1) and length > SHORTEST:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        h = before + (whole[:, None] - before - terms) * np.uint64(P_BACK)
        # Of equal letters in a row only the first is deleted: the others give the same text.
        new = np.ones(codes.shape, dtype=bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        word, at = np.nonzero(new)
        block, piece, z = layout.place(h[word, at], length - 1)
        mine = np.flatnonzero(piece == part) if layout.slices > 1 else np.arange(len(block))
        found = mine[passed(bits, block[mine], z[mine])]
        yield word[found], at[found], np.zeros(len(found), dtype=np.uint64)
    step = max(1, PROBES // max(1, n * len(alphabet)))
    for start in range(0, length, step):
        old = codes[:, start:start + step]
        word, at, letter = np.nonzero(alphabet[None, None, :] > old[:, :, None])
        put = alphabet[letter]
        h = whole[word] + (put - old[word, at]) * power[start + at]
        block, piece, z = layout.place(h, length)
        mine = np.flatnonzero(piece == part) if layout.slices > 1 else np.arange(len(block))
        found = mine[passed(bits, block[mine], z[mine])]
        yield word[found], start + at[found], put[found]


def candidates(words: DataFrame, alphabet: list[int], layout: Layout, bits, part: int) -> DataFrame:
    """``word``, ``n`` and ``edit`` for every edit that passes its filter; ``bits`` is broadcast."""
    letters = np.array(sorted(alphabet), dtype=np.uint64)

    def batches(it):
        table = np.frombuffer(bits.value, dtype=np.uint64)
        for batch in it:
            texts, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows, codes in grouped(texts):
                step = max(1, PROBES // max(1, codes.shape[1] * len(letters)))
                for at in range(0, len(rows), step):
                    for word, place, put in edits(codes[at:at + step], letters, layout, table, part):
                        of = rows[at:at + step][word].tolist()
                        made = [texts[r][:p] + (chr(c) if c else "") + texts[r][p + 1:] for r, p, c in zip(of, place.tolist(), put.tolist(), strict=True)]
                        if made:
                            yield pa.RecordBatch.from_arrays([pa.array([texts[r] for r in of], pa.string()), pa.array([n[r] for r in of], pa.int64()),
                                                              pa.array(made, pa.string())], names=["word", "n", "edit"])

    return in_arrow(words.select("word", "n"), batches, "word string, n long, edit string")


def near_words(words: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """All pairs of words at one edit, each way: ``word``, ``n``, ``near``, ``near_n``. ``words`` is a written table."""
    spark = words.sparkSession

    def seen(it):
        for batch in it:
            texts = batch.column(0).to_pylist()
            sizes = shard(np.array([len(w) for w in texts], dtype=np.int64)).tolist()
            of = Counter(sizes)
            letters = sorted({ord(c) for w in texts for c in w})
            yield pa.RecordBatch.from_arrays([pa.array(["shard"] * len(of) + ["letter"] * len(letters)), pa.array([*of.keys(), *letters], pa.int64()),
                                              pa.array([*of.values()] + [1] * len(letters), pa.int64())], names=["kind", "value", "n"])

    got = in_arrow(words.select("word"), seen, "kind string, value long, n long").groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    layout = Layout.of({r["value"]: r["n"] for r in got if r["kind"] == "shard"}, max_bytes)
    alphabet = [r["value"] for r in got if r["kind"] == "letter"]
    found = None
    for part in range(layout.slices):
        table = np.zeros((layout.total, 8), dtype=np.uint64)
        blocks = filter_blocks(words, layout, part).toArrow()
        at = blocks.column("block").to_numpy()
        for i in range(8):
            table[at, i] = blocks.column(f"b{i}").to_numpy().view(np.uint64)
        some = candidates(words, alphabet, layout, spark.sparkContext.broadcast(table.tobytes()), part)
        found = some if found is None else found.unionAll(some)
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = found.join(known, "edit")
    sides = F.explode(F.array(F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
                              F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(sides.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last of the chain word, form, form's form, ... ``forms``: ``word``, ``form``, each
    word once. Each round replaces a word's end by that end's end, so chains halve."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        ends = at.select(F.col("word").alias("root"), F.col("root").alias("later"))
        held = stage(at.join(ends, "root", "left").select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")), "spelling-roots")
        at = held.df.select("word", "root")
        if not held.df.where("moved").limit(1).count():
            return at


def spelling_groups(df: DataFrame, text: str = "text", key: str = "doc_id", fewest: int = FEWEST, ratio: int = LEAST_RATIO,
                    max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = stage(vocabulary(df, text, key, fewest), "spelling-words").df
    # -n first: of the most frequent neighbours the smallest text.
    best = (near_words(words, max_bytes).groupBy("word", "n")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")))
    wins = -F.col("best.less") >= ratio * F.col("n")
    near = stage(best.select("word", "n_near", F.when(wins, F.col("best.near")).alias("form"), F.when(wins, -F.col("best.less")).alias("form_n")), "spelling-near").df
    last = roots(near.where(F.col("form").isNotNull()))
    return (words.join(near, "word", "left").join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
