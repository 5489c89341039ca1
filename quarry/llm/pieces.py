"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised by the model's own rules and cut where no piece of the
vocabulary can cross: before a run of the white-space mark. (If some piece does
cross there, texts are not cut.) Each part is merged by an agenda: a heap of
adjacent symbol pairs ordered by the score of the piece they form, leftmost
first among equals; entries that a merge has made stale are skipped. Short parts of
equal length are merged together: their agendas are the rows of one array of pair
ranks, and in each step every row takes its first smallest, the same order without
the heap's bookkeeping. Symbols that are no piece fall back to their bytes.

Parts repeat, so a worker keeps encoded parts in a two-generation cache of fixed
size. Every part that is not in it is encoded by the agenda and, in one call per
slice of the Arrow batch, by the sentencepiece library; where the two differ the
library's ids are taken and counted in ``n_corrected``. Parts are independent, so
this checks whole texts. Decoding is the library's decode of the ids.

Defined cases: a null text counts as empty and gives the begin and end ids only.
White space, control characters and the mark itself are encoded as the library
does; texts of any length are encoded whole. Repeated rows give repeated rows;
an empty table gives an empty result. Other columns pass through unread.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import fresh, in_arrow, quoted, text_of

MARK = "▁"
CACHE = 100_000           # parts in each of the two generations
LONGEST_CACHED = 48      # characters
_SHORT = 40              # symbols up to which agendas are rows of an array
_NEVER = np.int32(2 ** 31 - 1)
_SLICE_CHARS = 1 << 20   # characters encoded between two calls of the library


class Agenda:
    """The merge rules of one model, as integers."""

    def __init__(self, sp):
        normal = {}
        self.bytes = {}
        for i in range(sp.vocab_size()):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                normal[sp.id_to_piece(i)] = i
        self.unknown = sp.unk_id()
        self.pieces = normal
        # Characters that only occur inside longer pieces get numbers after the vocabulary.
        chars = {c for p in normal for c in p} - normal.keys()
        self.symbols = normal | {c: sp.vocab_size() + k for k, c in enumerate(sorted(chars))}
        self.size = sp.vocab_size()
        scores = sorted({sp.get_score(i) for i in normal.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}  # equal scores share a rank
        self.none = self.size + len(chars)  # stands for characters of no piece; in no rule
        self.width = self.none + 1
        keys, ranks, made = [], [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    ranks.append(rank[sp.get_score(i)])
                    made.append(i)
        self._hash_rules(keys, ranks, made)
        # With one piece to a rank the rank tells the piece.
        self.piece_of_rank = np.zeros(len(scores), dtype=np.int32) if len(scores) == len(normal) else None
        if self.piece_of_rank is not None:
            for i in normal.values():
                self.piece_of_rank[rank[sp.get_score(i)]] = i
        self.of_char = np.full(0x110000, self.none, dtype=np.int32)
        for c, i in self.symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.lengths = {i: len(p) for p, i in normal.items()}
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)

    def parts(self, normalised: str) -> list[str]:
        if not normalised:
            return []
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", normalised) if self.cuts else [normalised]

    def _hash_rules(self, keys: list[int], ranks: list[int], made: list[int]) -> None:
        """The rules as an open-addressing table, for lookups of whole arrays."""
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift = 64 - bits
        self.keys = np.full((1 << bits) + 256, -1, dtype=np.int64)
        self.rank_of, self.piece_of = np.full(len(self.keys), _NEVER, dtype=np.int32), np.zeros(len(self.keys), dtype=np.int32)
        homes = self._home(np.array(keys, dtype=np.int64)).tolist()
        taken = bytearray(len(self.keys))
        for key, rank, piece, home in zip(keys, ranks, made, homes):
            at = taken.find(0, home)
            if at < 0 or at == len(taken) - 1:
                raise ValueError("rules do not spread over the table")
            taken[at] = 1
            self.keys[at], self.rank_of[at], self.piece_of[at] = key, rank, piece

    def _rule(self, left: int, right: int) -> tuple[int, int] | None:
        """Rank and piece of the rule for one pair."""
        key = left * self.width + right
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> self.shift
        while (found := self.keys.item(at)) != key:
            if found < 0:
                return None
            at += 1
        return self.rank_of.item(at), self.piece_of.item(at)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _slots(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table for each pair, and whether it is a rule's."""
        keys = left.astype(np.int64) * self.width + right
        at = self._home(keys)
        found = self.keys[at]
        left_over = np.flatnonzero((found != keys) & (found >= 0))
        while len(left_over):
            at[left_over] += 1
            now = self.keys[at[left_over]]
            found[left_over] = now
            left_over = left_over[(now != keys[left_over]) & (now >= 0)]
        return at, found == keys

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the rule for each pair, ``_NEVER`` if there is none."""
        at, known = self._slots(left, right)
        return np.where(known, self.rank_of[at], _NEVER)

    def encode(self, part: str) -> bytes:
        return self.encode_all([part])[0]

    def encode_all(self, parts: list[str]) -> list[bytes]:
        """Packed ids of each part."""
        out: list[bytes] = [b""] * len(parts)
        by_length: dict[int, list[int]] = {}
        for k, n in enumerate(map(len, parts)):
            by_length.setdefault(n, []).append(k)
        for n, which in by_length.items():
            if n <= _SHORT:
                chars = np.frombuffer("".join([parts[k] for k in which]).encode("utf-32-le"), dtype="<u4").reshape(-1, n)
                for rows, merged in self._merges(self.of_char[chars]):
                    width, packed = 4 * merged.shape[1], merged.astype("<u4").tobytes()
                    for i, row in enumerate(rows.tolist()):
                        out[which[row]] = packed[i * width:(i + 1) * width]
                    for i in np.flatnonzero((merged >= self.size).any(axis=1)).tolist():
                        k = which[rows[i]]
                        out[k] = self._fall_back(parts[k], merged[i].tolist())
            else:
                for k in which:
                    out[k] = self._fall_back(parts[k], self._by_heap(list(map(self.symbols.get, parts[k], repeat(self.none)))))
        return out

    def _by_rows(self, sym: np.ndarray) -> list[list[int]]:
        """The merged symbols of every row."""
        out: list[list[int]] = [[]] * len(sym)
        for rows, merged in self._merges(sym):
            for row, symbols in zip(rows.tolist(), merged.tolist()):
                out[row] = symbols
        return out

    def _merges(self, sym: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge rows of equally many symbols, each by its own agenda: row numbers and their
        symbols, as they are done."""
        n = sym.shape[1]
        rows, length = np.arange(len(sym)), n
        rank = self._ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(len(sym), n - 1)
        while len(rows):
            k = np.arange(len(rows))
            if length > 1:
                at = rank.argmin(axis=1)
                best = rank[k, at]
                done = best == _NEVER
            else:
                done = np.ones(len(rows), dtype=bool)
            if done.any():
                yield rows[done], sym[done]
                if done.all():
                    break
                left = ~done
                rows, sym, rank, at, best = rows[left], sym[left], rank[left], at[left], best[left]
                k = np.arange(len(rows))
            if self.piece_of_rank is not None:
                sym[k, at] = self.piece_of_rank[best]
            else:
                sym[k, at] = self.piece_of[self._slots(sym[k, at], sym[k, at + 1])[0]]
            # One symbol and one pair fewer: what lies behind them moves up.
            stays = np.ones(sym.shape, dtype=bool)
            stays[k, at + 1] = False
            sym = sym[stays].reshape(len(rows), length - 1)
            stays = np.ones(rank.shape, dtype=bool)
            stays[k, at] = False
            rank = rank[stays].reshape(len(rows), length - 2)
            length -= 1
            after, before = np.flatnonzero(at < length - 1), np.flatnonzero(at > 0)
            r, c = np.concatenate([after, before]), np.concatenate([at[after], at[before] - 1])
            rank[r, c] = self._ranks(sym[r, c], sym[r, c + 1])

    def _by_heap(self, sym: list[int]) -> list[int]:
        rule, n = self._rule, len(sym)
        heap = []
        for at in range(n - 1):
            if (m := rule(sym[at], sym[at + 1])):
                heap.append(m[0] << 40 | at)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = [False] * n
        while heap:
            entry = heapq.heappop(heap)
            at = entry & 0xFFFFFFFFFF
            nxt = after[at]
            if gone[at] or nxt >= n:
                continue
            m = rule(sym[at], sym[nxt])
            if m is None or m[0] != entry >> 40:
                continue  # one of the two has become part of another piece
            sym[at], gone[nxt] = m[1], True
            nxt = after[at] = after[nxt]
            if nxt < n:
                before[nxt] = at
                if (m := rule(sym[at], sym[nxt])):
                    heapq.heappush(heap, m[0] << 40 | at)
            prev = before[at]
            if prev >= 0 and (m := rule(sym[prev], sym[at])):
                heapq.heappush(heap, m[0] << 40 | prev)
        return [s for s, g in zip(sym, gone) if not g]

    def _fall_back(self, part: str, merged: list[int]) -> bytes:
        """Bytes, or else the unknown id, for characters that are in no piece of their own."""
        out, at = [], 0
        for s in merged:
            if s < self.size:
                out.append(s)
                at += self.lengths[s]
                continue
            if self.bytes:
                out.extend(self.bytes[b] for b in part[at].encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            at += 1
        return struct.pack(f"<{len(out)}I", *out)


class Codec:
    """One model in one worker, with its cache of encoded parts."""

    def __init__(self, path: str, begin_end: bool = True):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.agenda = Agenda(self.sp)
        self.head = np.array([self.sp.bos_id()] * begin_end, dtype="<u4").tobytes()
        self.tail = np.array([self.sp.eos_id()] * begin_end, dtype="<u4").tobytes()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.plain = self.sp.normalize("a  b") == MARK + "a" + MARK * 2 + "b"

    def _library(self, parts: list[str]) -> list[list[int]]:
        """The library's ids of parts; the mark it puts before a text is the part's first."""
        return self.sp.encode([p[1:].replace(MARK, " ") for p in parts], num_threads=1)

    def _check(self, parts: list[str], ours: list[bytes], wrong: set[str]) -> None:
        """Compare the parts' ids with the library's; where they differ take the latter and note the part."""
        theirs = self._library(parts)
        flat = np.fromiter(chain.from_iterable(theirs), dtype="<u4")
        if list(map(len, ours)) == [4 * len(t) for t in theirs] and b"".join(ours) == flat.tobytes():
            return
        for k, (part, ids) in enumerate(zip(parts, theirs)):
            if part != MARK and ours[k] != (packed := struct.pack(f"<{len(ids)}I", *ids)):
                wrong.add(part)
                ours[k] = packed

    def encode(self, texts: list[str]) -> list[tuple[bytes, int]]:
        """Packed ids (little-endian, 32 bits) and corrected parts, for each text."""
        cut = [self.agenda.parts(t) for t in self.sp.normalize(texts)]
        found = dict.fromkeys(chain.from_iterable(cut))
        young, old, missing = self.young, self.old, []
        for part in found:
            if (ids := young.get(part)) is None:
                if (ids := old.get(part)) is None:
                    missing.append(part)
                    continue
                young[part] = ids
            found[part] = ids
        wrong = set()
        if missing:
            ours = self.agenda.encode_all(missing)
            if self.plain and self.agenda.cuts:
                self._check(missing, ours, wrong)
            found.update(zip(missing, ours))
            self.young.update((p, ids) for p, ids in zip(missing, ours) if len(p) <= LONGEST_CACHED)
            for p in wrong:
                self.young.pop(p, None)
            if len(self.young) > CACHE:
                self.old, self.young = self.young, {}
        out = []
        for text, parts in zip(texts, cut):
            ids = b"".join((self.head, *map(found.__getitem__, parts), self.tail))
            if not (self.plain and self.agenda.cuts):  # other models: checked text by text
                theirs = np.array(self.sp.encode(text), dtype="<u4").tobytes()
                bad = ids != b"".join((self.head, theirs, self.tail))
                out.append((b"".join((self.head, theirs, self.tail)), int(bad)))
            else:
                out.append((ids, sum(p in wrong for p in parts) if wrong else 0))
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        return self.sp.decode([np.frombuffer(p, dtype="<u4").tolist() for p in packed])


_CODECS: dict[tuple[str, bool], Codec] = {}


def codec(path: str, begin_end: bool = True) -> Codec:
    """The worker process's codec, kept with its cache from task to task."""
    if (path, begin_end) not in _CODECS:
        _CODECS[path, begin_end] = Codec(path, begin_end)
    return _CODECS[path, begin_end]


def _slices(texts) -> Iterator[list[str]]:
    """Lists of strings from an Arrow column or a list, of about as many characters each."""
    part, chars = [], 0
    for t in texts:
        t = t if isinstance(t, str) else t.as_py()
        part.append(t)
        chars += len(t)
        if chars >= _SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def encoded(df: DataFrame, model: str, text: str = "text", keep: list[str] | None = None,
            begin_end: bool = True) -> DataFrame:
    """``keep`` columns (all but the text by default), then ids (binary: little-endian unsigned
    32-bit), n_tokens, decoded (the text that the ids decode to) and n_corrected."""
    keep = [c for c in df.columns if c != text] if keep is None else keep
    body = fresh(df, "__text")
    src = df.select(*[df[quoted(c)] for c in keep], text_of(df, text).alias(body))
    kept = df.select(*[df[quoted(c)] for c in keep])
    kind = kept.schema
    for name, of in (("ids", "binary"), ("n_tokens", "long"), ("decoded", "string"), ("n_corrected", "long")):
        kind = kind.add(fresh(kept, name), of)

    def batches(it):
        own = codec(model, begin_end)
        for batch in it:
            texts = batch.column(len(keep))
            at = 0
            for part in _slices(texts):
                done = own.encode(part)
                packed = [p for p, _ in done]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(at, len(part)) for i in range(len(keep))],
                    pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array(own.decode(packed), pa.string()), pa.array([n for _, n in done], pa.int64())],
                    names=[f.name for f in kind])
                at += len(part)

    return in_arrow(src, batches, kind)
