"""SimHash near-duplicates by a generalised pigeonhole search.

A fingerprint is the majority vote of the 64-bit hashes of a document's word
shingles. To find all fingerprints within ``distance`` bits, the 64 bits are cut
into m partitions of correlated bits. Each fingerprint gets a threshold T_i per
partition (-1: not probed) with sum(T) = distance - m + 1; if two fingerprints
are within ``distance``, then in at least one partition they differ in at most
T_i bits, whatever the allocation. The allocation is chosen per fingerprint by
dynamic programming on candidate counts, estimated from value histograms of the
corpus. Every fingerprint is indexed under its value in each partition and
probes the values within T_i of its own; candidates are verified on all 64 bits.

Copies count once: the search runs over distinct fingerprints. An index bucket
with more than ``bucket_cap`` entries would make pairs with the square of its
size. Its fingerprints (all of them) are linked another exact way instead: each
is listed under itself and every value within ``distance // 2`` bits (odd
distances: one side a bit more); two fingerprints are within ``distance`` if
and only if they meet in such a ball, and no ball holds more fingerprints than
there are values around its centre, so these groups are bounded however the
data look.

Python runs in Arrow batches to hash shingles and to lay out probes; joins,
grouping and components are Spark's.

Defined cases: null and empty texts, or ones of white space only, have the
fingerprint zero and are linked like any other. Texts with fewer words than a
shingle hash the whole sequence. A null identifier never becomes a component id
unless the component has no other. Repeated rows keep their rows. Empty tables
give empty results. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import FILE, ROW, in_arrow, located, quoted, text_of, without_rows
from quarry.llm.components import components
from quarry.operators.staging import broadcast_if_small, stage

SHINGLE = 3
DISTANCE = 2
SEED = 42
BUCKET_CAP = 64
_BLOCK = 8          # bits per histogram of the estimator
_SLICE = 1 << 15    # shingles, and probe rows, held as arrays at once


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()  # on bytes: A-Z only, and exactly the white space of the rule
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        n -= shingle - 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    votes = np.zeros(64, dtype=np.int64)
    hashes = (xxhash.xxh64_intdigest(g, seed) for g in grams)
    while (h := np.fromiter(itertools.islice(hashes, _SLICE), dtype="<u8")).size:
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """A located frame's locator and other columns given, with ``fp`` (long) for ``text``."""
    keep = [c for c in df.columns if c != text]
    df = df.select(text, *keep)
    kind = df.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def batches(it):
        for batch in it:
            texts = batch.column(0).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), dtype="<u8", count=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps.view("<i8"))], names=[*keep, "fp"])

    return in_arrow(df, batches, kind)


# ------------------------------------------------- partitions and thresholds

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlation(distinct: DataFrame) -> np.ndarray:
    """64 x 64 correlations of the bits over all distinct fingerprints (64 rows reach the driver)."""
    def partial(it):
        both, n = np.zeros((64, 64), dtype=np.int64), 0
        for batch in it:
            fps = batch.column(0).to_numpy().view("<u8")
            for at in range(0, len(fps), _SLICE):
                x = _bits(fps[at:at + _SLICE]).astype(np.float32)  # sums stay below 2^24: exact
                both += (x.T @ x).astype(np.int64)
            n += len(fps)
        yield pa.RecordBatch.from_pydict({"bit": list(range(64)), "both": both.tolist(), "n": [n] * 64},
                                         schema=pa.schema([("bit", pa.int64()), ("both", pa.list_(pa.int64())), ("n", pa.int64())]))

    parts = in_arrow(distinct.select("fp"), partial, "bit long, both array<long>, n long")
    sums = parts.groupBy("bit").agg(*[F.sum(F.col("both")[i]).alias(f"b{i}") for i in range(64)], F.sum("n").alias("n")).collect()
    if not sums or not sums[0]["n"]:
        return np.eye(64)
    both = np.zeros((64, 64))
    for r in sums:
        both[r["bit"]] = [r[f"b{i}"] for i in range(64)]
    both /= sums[0]["n"]
    p = np.diag(both)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    cov = both - np.outer(p, p)
    return np.divide(cov, spread, out=np.zeros_like(cov), where=spread > 1e-12)


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near-equal size, each grown by the bit most correlated with it."""
    strength = np.abs(correlation) - np.eye(64) * np.abs(np.diag(correlation))
    free, groups = set(range(64)), []
    for g in range(m):
        size = len(free) // (m - g)
        group = [max(free, key=lambda b: (strength[b, list(free)].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _masks(groups: list[list[int]]) -> np.ndarray:
    return np.array([sum(1 << b for b in g) for g in groups], dtype=np.uint64)


def _blocks(groups: list[list[int]]) -> list[list[list[int]]]:
    return [[g[i:i + _BLOCK] for i in range(0, len(g), _BLOCK)] for g in groups]


def _block_value(bits: np.ndarray, block: list[int]) -> np.ndarray:
    return bits[:, block].astype(np.int64) @ (1 << np.arange(len(block)))


def value_histograms(distinct: DataFrame, groups: list[list[int]]) -> dict[tuple[int, int], np.ndarray]:
    """How often each value of each block of at most 8 bits occurs, over all distinct
    fingerprints. At most 64 / 8 + m blocks of 256 numbers reach the driver."""
    blocks = [(i, j, b) for i, g in enumerate(_blocks(groups)) for j, b in enumerate(g)]

    def partial(it):
        counts = {(i, j): np.zeros(1 << len(b), dtype=np.int64) for i, j, b in blocks}
        for batch in it:
            fps = batch.column(0).to_numpy().view("<u8")
            for at in range(0, len(fps), _SLICE):
                bits = _bits(fps[at:at + _SLICE])
                for i, j, b in blocks:
                    counts[i, j] += np.bincount(_block_value(bits, b), minlength=1 << len(b))
        rows = [(i, j, v, int(c)) for (i, j), a in counts.items() for v, c in enumerate(a) if c]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["i", "j", "v", "c"])

    sums = in_arrow(distinct.select("fp"), partial, "i long, j long, v long, c long").groupBy("i", "j", "v").agg(F.sum("c").alias("c"))
    out = {(i, j): np.zeros(1 << len(b)) for i, j, b in blocks}
    for r in sums.collect():
        out[r["i"], r["j"]][r["v"]] = r["c"]
    return out


class Allocation:
    """Thresholds per fingerprint: least estimated candidates plus probes, sum fixed."""

    def __init__(self, groups: list[list[int]], histograms: dict[tuple[int, int], np.ndarray], distance: int):
        self.groups, self.distance = groups, distance
        self.blocks = _blocks(groups)
        self.total = float(next(iter(histograms.values())).sum()) if histograms else 0.0
        # near[i][j][v, e]: share of the corpus that differs from v in exactly e bits of block j.
        self.near = []
        for i, g in enumerate(self.blocks):
            tables = []
            for j, b in enumerate(g):
                hist = histograms[i, j] / max(self.total, 1.0)
                values = np.arange(1 << len(b))
                apart = np.array([bin(v).count("1") for v in range(1 << len(b))])[values[:, None] ^ values[None, :]]
                tables.append(np.stack([(hist * (apart == e)).sum(axis=1) for e in range(distance + 1)], axis=1))
            self.near.append(tables)

    def candidates(self, bits: np.ndarray) -> np.ndarray:
        """[row, partition, e + 1]: expected candidates and probes at threshold e, from -1."""
        d, out = self.distance, np.zeros((len(bits), len(self.groups), self.distance + 2))
        for i, g in enumerate(self.blocks):
            exact = np.zeros((len(bits), d + 1))
            exact[:, 0] = 1.0
            for j, b in enumerate(g):
                step = self.near[i][j][_block_value(bits, b)]
                exact = np.stack([sum(exact[:, k] * step[:, e - k] for k in range(e + 1)) for e in range(d + 1)], axis=1)
            width = len(self.groups[i])
            probes = np.cumsum([math.comb(width, e) for e in range(d + 1)])
            out[:, i, 1:] = np.cumsum(exact, axis=1) * self.total + probes
        return out

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """[row, partition]: the allocation of least cost, found partition by partition."""
        cost = self.candidates(_bits(fps))
        n, m, width = cost.shape
        goal = self.distance + 1  # thresholds + 1 sum to distance - m + 1 + m
        best = np.full((n, goal + 1), np.inf)
        best[:, 0] = 0.0
        choice = np.zeros((m, n, goal + 1), dtype=np.int8)
        for i in range(m):
            after = np.full_like(best, np.inf)
            for t in range(min(width, goal + 1)):
                trial = best[:, :goal + 1 - t] + cost[:, i, t:t + 1]
                better = trial < after[:, t:]
                after[:, t:][better] = trial[better]
                choice[i][:, t:][better] = t
            best = after
        out, left, rows = np.zeros((n, m), dtype=np.int8), np.full(n, goal), np.arange(n)
        for i in reversed(range(m)):
            t = choice[i][rows, left]
            out[:, i] = t - 1
            left = left - t
        return out


def _flips(group: list[int], e: int) -> np.ndarray:
    """Masks that flip at most e of the group's bits."""
    return np.array([sum(1 << b for b in c) for k in range(e + 1) for c in itertools.combinations(group, k)], dtype=np.uint64)


def choose_partitions(n: int, distance: int) -> int:
    """The m of least expected work for n evenly spread fingerprints; any m finds the same links."""
    def work(m):
        groups = group_bits(np.eye(64), m)
        flat = {(i, j): np.full(1 << len(b), n / (1 << len(b))) for i, g in enumerate(_blocks(groups)) for j, b in enumerate(g)}
        a = Allocation(groups, flat, distance)
        zero = np.zeros(1, dtype=np.uint64)
        cost, t = a.candidates(_bits(zero))[0], a.thresholds(zero)[0]
        return m + sum(cost[i, e + 1] for i, e in enumerate(t))
    return min(range(1, distance + 3), key=work)


def probe_rows(distinct: DataFrame, groups: list[list[int]], allocation: Allocation) -> DataFrame:
    """part, value, fp, indexed, probing: every fingerprint in the index of each partition,
    and its probes within its own thresholds."""
    masks = _masks(groups)
    flips = {(i, e): _flips(g, e) for i, g in enumerate(groups) for e in range(allocation.distance + 1)}
    widest = max(len(f) for f in flips.values())
    step = max(1, (1 << 18) // widest)

    def lay_out(it):
        for batch in it:
            every = batch.column(0).to_numpy().view("<u8")
            for at in range(0, len(every), step):
                fps = every[at:at + step]
                thresholds = allocation.thresholds(fps)
                for i, mask in enumerate(masks):
                    for e in np.unique(thresholds[:, i]):
                        own = fps[thresholds[:, i] == e]
                        f = flips[i, int(e)] if e >= 0 else np.zeros(1, dtype=np.uint64)
                        value = ((own & mask)[:, None] ^ f[None, :]).ravel()
                        first = np.tile(np.arange(len(f)) == 0, len(own))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(value), i, dtype=np.int8)), pa.array(value.view("<i8")),
                            pa.array(np.repeat(own, len(f)).view("<i8")), pa.array(first),
                            pa.array(np.full(len(value), bool(e >= 0)))],
                            names=["part", "value", "fp", "indexed", "probing"])

    return in_arrow(distinct.select("fp"), lay_out, "part byte, value long, fp long, indexed boolean, probing boolean")


# ------------------------------------------------------------------- linking

def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _balls(fps: DataFrame, distance: int) -> DataFrame:
    """Edges between all fingerprints within ``distance``, as stars around shared centres.

    Both are within the half distance of a common centre if and only if they are within
    the distance; for an odd one, the ball has the larger half and the star is verified
    pair by pair (a ball is bounded by its number of values)."""
    near = [sum(1 << b for b in c) for k in range((distance + 1) // 2 + 1) for c in itertools.combinations(range(64), k)]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in near]
    listed = fps.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in signed])).alias("flip"))
    balls = (listed.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
             .agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1))
    if distance % 2 == 0:
        return balls.select(F.explode(F.slice("fps", 2, F.size("fps"))).alias("a"), F.col("fps")[0].alias("b"))
    pairs = balls.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    return pairs.where((F.col("a") > F.col("b")) & (_apart("a", "b") <= distance)).distinct()


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, partitions: int | None = None,
                      bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """Edges a, b over distinct fingerprints (staged column ``fp``) that connect all that are
    connected by links of at most ``distance`` bits."""
    n = distinct.count()
    if n < 2:
        return distinct.limit(0).select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    groups = group_bits(bit_correlation(distinct), partitions or choose_partitions(n, distance))
    allocation = Allocation(groups, value_histograms(distinct, groups), distance)
    laid = stage(probe_rows(distinct, groups, allocation), "simhash-probes").df
    sizes = laid.groupBy("part", "value").agg(
        F.count_if("indexed").alias("listed"), F.count(F.lit(1)).alias("rows"))
    sizes = stage(sizes.where("listed > 0 and rows > 1"), "simhash-buckets").df
    useful = sizes.where(F.col("rows") <= bucket_cap).select("part", "value")
    full = broadcast_if_small(stage(sizes.where(F.col("rows") > bucket_cap).select("part", "value"), "simhash-full"))

    rows = stage(laid.join(useful, ["part", "value"], "left_semi"), "simhash-useful").df
    index = rows.where("indexed").select("part", "value", F.col("fp").alias("b"))
    probes = rows.where("probing").select("part", "value", F.col("fp").alias("a"))
    verified = (probes.join(index, ["part", "value"])
                .where((F.col("a") != F.col("b")) & (_apart("a", "b") <= distance)).select("a", "b"))
    crowded = laid.join(full, ["part", "value"], "left_semi").select("fp").distinct()
    return verified.unionByName(_balls(crowded, distance))


def simhash_components(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                       distance: int = DISTANCE, bucket_cap: int = BUCKET_CAP,
                       partitions: int | None = None) -> DataFrame:
    """One row per input row: locator, ``key``, fingerprint (16 hex digits), component_id (the
    smallest key reachable over links of at most ``distance`` bits), keep (the locator that
    stands for the component: smallest key, null last, then first by locator)."""
    src = df if FILE in df.columns else located(df, "simhash-input")
    wanted = src.select(F.col(FILE), F.col(ROW), src[quoted(key)].alias("key"), text_of(src, text).alias("text"))
    rows = stage(fingerprints(wanted, "text", shingle), "simhash-fingerprints").df
    first = F.struct(F.col("key").isNull().alias("no_key"), F.col("key").alias("key"),
                     F.col(FILE).alias("file"), F.col(ROW).alias("row"))
    distinct = stage(rows.groupBy("fp").agg(F.min(first).alias("first")), "simhash-distinct").df
    roots = components(fingerprint_links(distinct, distance, partitions, bucket_cap))
    rooted = stage(distinct.join(roots, F.col("fp") == F.col("node"), "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted").df
    lowest = rooted.groupBy("root").agg(F.min("first").alias("keep"))
    named = rooted.join(lowest, "root").select("fp", "keep")
    return rows.join(named, "fp").select(
        FILE, ROW, F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("keep.key").alias("component_id"),
        ((F.col(FILE) == F.col("keep.file")) & (F.col(ROW) == F.col("keep.row"))).alias("kept"))


def near_dedup(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
               distance: int = DISTANCE) -> DataFrame:
    """The rows of ``df`` that stand for their component, with all their columns."""
    src = located(df, "simhash-input")
    groups = simhash_components(src, text, key, shingle, distance)
    return without_rows(src, groups.where(~F.col("kept")), df.columns)
