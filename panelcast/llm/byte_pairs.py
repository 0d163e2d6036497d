"""Byte-level BPE encoding and decoding in padded numpy matrices.

A text is cut by the vocabulary's pattern, and every cut piece is encoded by itself: a piece
that is a token is that token, any other starts as single bytes and merges, over and over,
its leftmost pair of least rank. A task does that for many pieces at once:

- the different pieces that its worker has not met yet are bucketed by length, each bucket a
  matrix of ids, one piece a row, padded to the bucket's width;
- in each round every row merges its leftmost pair of least rank; pairs are looked up in a hash
  table of all pairs of tokens that make a token, and only the two pairs beside a merge anew;
- the row closes the gap, the matrix loses a column, and rows without a pair left leave it.

Pieces above ``WIDEST`` bytes, which a round each would make quadratic, merge in a heap of pairs
by (rank, place): the same order, n log n. Decoding copies the tokens' bytes by offsets.

The pattern's character classes are asked from the tokenizer library once on the driver, because
libraries follow different versions of Unicode.

Cases: a null or empty text has no ids and decodes to no bytes; null ids of rows and repeated
rows are kept as they are; characters the pattern does not match are left out, as the library
leaves them out; strings of special tokens are plain text; other columns are ignored, whatever
their names; an empty table gives an empty result. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tokens import LONGEST_CACHED, process_state

WIDEST = 256
# Cells of one matrix, pieces a worker remembers (some 50 MB), bytes of text encoded together.
CELLS = 1 << 20
CACHE_SIZE = 200_000
GROUP_BYTES = 4_000_000
NONE = np.int32(2**31 - 1)


# --- the pattern -------------------------------------------------------------------------


def class_ranges(code: str) -> str:
    """The characters the tokenizer library counts to a class such as ``\\p{L}``, as ranges."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    asked = tiktoken.Encoding("classes", pat_str=code, mergeable_ranks=single, special_tokens={})
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    points = np.frombuffer(bytes(asked.encode_ordinary(every)).decode().encode("utf-32-le"), "<u4").astype(np.int64)
    breaks = np.flatnonzero(np.diff(points) > 1)
    first, last = points[np.r_[0, breaks + 1]], points[np.r_[breaks, len(points) - 1]]
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(first.tolist(), last.tolist()))


def spelled_out(pattern: str) -> str:
    """``pattern`` with its classes as ranges of characters, for Python's own engine."""
    known: dict[str, str] = {}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\[sS]|\\.|.", pattern, re.DOTALL):
        if part in ("[", "]"):
            inside = part == "["
        if part.startswith(r"\p") or part in (r"\s", r"\S"):
            code = r"\s" if part == r"\S" else part
            known[code] = known.get(code) or class_ranges(code)
            if inside and part == r"\S":
                raise ValueError("a negated class inside brackets is not supported")
            out.append(known[code] if inside else f"[{'^' if part == chr(92) + 'S' else ''}{known[code]}]")
        else:
            out.append(part)
    return "".join(out)


# --- the vocabulary ----------------------------------------------------------------------


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a file with a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairTable:
    """Hash table (first id, second id) -> id of the two joined, with linear probing."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, ranks: dict[bytes, int]):
        made = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
                for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, joined = np.array(made, np.int64).reshape(-1, 3).T
        self.bits = max(4, len(made).bit_length() + 2)
        self.keys = np.full(1 << self.bits, self.EMPTY)
        self.values = np.full(1 << self.bits, NONE)
        key = self.key(a, b)
        slot, value = self.slot(key), joined.astype(np.int32)
        while len(key):
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = key[free]  # of several for one slot the last stays
            mine = self.keys[slot] == key
            self.values[slot[mine]] = value[mine]
            key, slot, value = key[~mine], self.next(slot[~mine]), value[~mine]

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of each pair joined, ``NONE`` for pairs that are no token."""
        key = self.key(a, b)
        slot = self.slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.values[slot], NONE)
        open_ = np.flatnonzero((held != key) & (held != self.EMPTY))
        while len(open_):
            slot[open_] = self.next(slot[open_])
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held != self.EMPTY)]
        return out


class Vocabulary:
    """Encodes pieces and decodes ids by the ranks of a file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        by_rank = sorted(ranks, key=ranks.__getitem__)
        self.letters = np.frombuffer(b"".join(by_rank), np.uint8)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of every piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = np.array([self.ranks[piece]], np.int32)
            elif len(piece) > WIDEST:
                out[i] = self.encode_long(piece)
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, members in sorted(buckets.items()):
            rows = max(1, CELLS >> bits)
            for at in range(0, len(members), rows):
                part = members[at:at + rows]
                for i, ids in zip(part, self.encode_matrix([pieces[i] for i in part], 1 << bits)):
                    out[i] = ids
        return out

    def encode_matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Pieces of one bucket, two bytes at least and ``width`` at most."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = self.byte_ids[raw]
        column = np.arange(width)
        rank = np.full((len(pieces), width), NONE)
        paired = column[None, 1:] < length[:, None]
        rank[:, :-1][paired] = self.pairs(ids[:, :-1][paired], ids[:, 1:][paired])
        row = np.arange(len(pieces))
        while len(row):
            at = rank.argmin(axis=1)  # the leftmost of the least
            line = np.arange(len(row))
            joined = rank[line, at]
            done = joined == NONE
            for k in np.flatnonzero(done).tolist():
                out[row[k]] = ids[k, :length[k]].copy()
            if done.any():
                left = ~done
                ids, rank, row, length, at, joined = (x[left] for x in (ids, rank, row, length, at, joined))
                line = np.arange(len(row))
                if not len(row):
                    break
            ids[line, at] = joined
            width, length = ids.shape[1] - 1, length - 1
            column = np.arange(width)
            behind = column[None, :]
            ids = np.take_along_axis(ids, behind + (behind > at[:, None]), axis=1)
            rank = np.take_along_axis(rank, behind + (behind >= at[:, None]), axis=1)
            rank[:, -1] = NONE
            rank[line, at] = NONE
            for place in (at - 1, at):  # the pairs left and right of what was joined
                k = np.flatnonzero((place >= 0) & (place + 1 < length))
                rank[k, place[k]] = self.pairs(ids[k, place[k]], ids[k, place[k] + 1])
        return out

    def encode_long(self, piece: bytes) -> np.ndarray:
        """One long piece, pairs kept in a heap by (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pairs(ids[:-1], ids[1:])
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, current = ids.tolist(), [*first.tolist(), int(NONE)]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known: dict[tuple[int, int], int] = {}

        def joined(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.pairs(np.array([a]), np.array([b]))[0])
            return known[a, b]

        def refresh(i: int) -> None:
            current[i] = joined(ids[i], ids[after[i]]) if after[i] < n else int(NONE)
            if current[i] != NONE:
                heapq.heappush(heap, (current[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if current[i] != r:
                continue
            gone = after[i]
            ids[i], after[i], current[gone] = r, after[gone], -1
            if after[i] < n:
                before[after[i]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return np.array([x for x, c in zip(ids, current) if c != -1], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, one after the other."""
        parts = []
        for at in range(0, len(ids), CELLS):
            part = ids[at:at + CELLS]
            length = self.lengths[part]
            shift = self.starts[part] - (np.cumsum(length) - length)
            parts.append(self.letters[np.repeat(shift, length) + np.arange(int(length.sum()))].tobytes())
        return b"".join(parts)


def worker_vocabulary(path: str, ranks: dict[bytes, int]) -> tuple[Vocabulary, dict[str, bytes]]:
    """The worker's vocabulary and its cache: piece -> its ids as bytes; kept between tasks."""
    state, key = process_state(), f"byte pairs {path}"
    if key not in state:
        state[key] = Vocabulary(ranks), {}
    return state[key]


# --- texts -------------------------------------------------------------------------------


def encode_texts(texts: Iterable[str], cut: re.Pattern, vocabulary: Vocabulary, cache: dict[str, bytes]) -> list[np.ndarray]:
    """The ids of every text; pieces the cache lacks are encoded together."""
    cuts = [cut.findall(t) for t in texts]
    if len(cache) > CACHE_SIZE:
        cache.clear()
    new = list(set().union(*cuts).difference(cache))
    for piece, ids in zip(new, vocabulary.encode([p.encode() for p in new])):
        cache[piece] = ids.astype("<i4").tobytes()
    out = [np.frombuffer(b"".join(map(cache.__getitem__, pieces)), "<i4") for pieces in cuts]
    for piece in new:
        if len(piece) > LONGEST_CACHED:
            del cache[piece]
    return out


def _groups(batches):
    """(type of the ids, ids, texts) of bounded size."""
    names, texts, size = [], [], 0
    for batch in batches:
        kind = batch.column(0).type
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            names.append(name)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= GROUP_BYTES:
                yield kind, names, texts
                names, texts, size = [], [], 0
    if names:
        yield kind, names, texts


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, "<i4"), *found]), pa.int32()))


def _encoded(docs: DataFrame, path: str, pattern: str, doc_id: str, text: str, decoded: bool) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    spelled = spelled_out(pattern)

    def run(batches):
        cut = re.compile(spelled)
        vocabulary, cache = worker_vocabulary(path, ranks.value)
        for kind, names, texts in _groups(batches):
            found = encode_texts(texts, cut, vocabulary, cache)
            columns = {"doc_id": pa.array(names, kind), "ids": _lists(found)}
            if decoded:
                columns["decoded"] = pa.array([vocabulary.decode(ids) for ids in found], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    of_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {of_id}, ids array<int>" + (", decoded binary" if decoded else ""))


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""
    return _encoded(docs, path, pattern, doc_id, text, decoded=False)


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs``: the ids, and the bytes they stand for."""
    return _encoded(docs, path, pattern, doc_id, text, decoded=True)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the bytes of its ids; null for null."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    place = encoded.columns.index(ids)

    def run(batches):
        vocabulary, _ = worker_vocabulary(path, ranks.value)
        for batch in batches:
            made = [None if x.as_py() is None else vocabulary.decode(x.values.to_numpy(zero_copy_only=False).astype(np.int64))
                    for x in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def digests(trips: DataFrame) -> DataFrame:
    """Counts and checksums of ``round_trip``."""
    return trips.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
