"""Packing of token pieces into sequences by a configuration linear program.

A sequence is a configuration: a multiset of piece lengths that fits. How often each
configuration is used follows from the length histogram alone, which has at most
``capacity`` entries whatever the corpus holds, so the program is solved on the driver and
the pieces stay on the executors:

1. multiplicative weights keep a price per length; in every round the configuration of
   highest price is found by the knapsack recurrence and takes an equal share of the
   sequences, and lengths that lag behind their demand become dearer;
2. the shares are rounded down to whole sequences;
3. lengths left over are packed best-fit, longest first, into the gaps and new sequences, in
   run-length form.

Pieces then get their place by their rank among the pieces of their length. Ranks come from
counts per (chunk, length) and a row number inside it, so no length is gathered in one task.

Cases: a null or empty text has its closing id only; null ids and repeated rows are packed
as separate rows; equal lengths are interchangeable; extra columns of ``pieces`` stay; an
empty table gives an empty result. Texts of any length are encoded whole.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.tables import Written
from panelcast.llm.tokens import WORD_PIECES, WORD_RUNS, worker_encoder

CAPACITY = 2048
CLOSING_ID = 0
ROUNDS = 240
# Strength of a price's answer to a lag of one round.
RATE = 0.08
# Bytes of ids that are sent on together, to bound memory.
GROUP_BYTES = 16_000_000


# --- pieces ------------------------------------------------------------------------------


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): token ids of every text and its closing id.

    ``ids`` holds little-endian unsigned 32-bit numbers. Only texts above ``capacity`` are cut.
    """
    closing = np.array([CLOSING_ID], dtype="<u4").tobytes()

    def packed(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def encode(batches):
        ids_of = worker_encoder("ids", vocabulary_path, pieces=WORD_PIECES, runs=WORD_RUNS, value=packed, join=b"".join, lower=True)

        def rows(ids, values):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
            for name, value in zip(ids, values):
                value += closing
                for k, at in enumerate(range(0, len(value), 4 * capacity)):
                    part = value[at:at + 4 * capacity]
                    for column, x in zip(out.values(), (name, k, at // 4, len(part) // 4, part)):
                        column.append(x)
            return pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], id_type), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary())], names=list(out))

        for batch in batches:
            id_type = batch.column(0).type
            names, values, size = [], [], 0
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(name)
                values.append(ids_of(value.as_py() or ""))
                size += len(values[-1])
                if size > GROUP_BYTES:
                    yield rows(names, values)
                    names, values, size = [], [], 0
            if names:
                yield rows(names, values)

    rows_in = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids binary")


# --- the program -------------------------------------------------------------------------


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is taken in the dearest multiset that fits."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    usable = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = usable[c]
        if k:
            gain = best[c - sizes[:k]] + prices[:k]
            i = int(gain.argmax())
            if gain[i] > best[c]:
                best[c], choice[c] = gain[i], i
    take = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            take[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return take


def shares(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Fractional use of configurations; a configuration is a tuple of places in ``sizes``."""
    step = float((sizes * demand).sum()) / capacity / rounds
    base, covered = sizes / capacity, np.zeros(len(sizes))
    use: dict[tuple[int, ...], float] = {}
    for t in range(rounds):
        unmet = covered < demand
        if not unmet.any():
            break
        lag = np.clip(t - rounds * covered / demand, -60, 60)
        take = knapsack(sizes, np.where(unmet, base * np.exp(RATE * lag), 0.0), capacity)
        covered += step * take
        key = tuple(np.repeat(np.arange(len(sizes)), take).tolist())
        use[key] = use.get(key, 0.0) + step
    return use


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[int, list[int]]]:
    """(how many sequences, piece lengths in each): places for every piece of ``histogram``."""
    left = {s: n for s, n in histogram.items() if n > 0}
    made: list[tuple[int, list[int]]] = []
    if left.get(capacity):
        made.append((left.pop(capacity), [capacity]))
    if not left:
        return made
    sizes = np.array(sorted(left))
    use = shares(sizes, np.array([left[s] for s in sizes.tolist()]), capacity, rounds)
    open_: dict[int, list[list]] = {}  # room -> [[sequences, lengths]]

    def keep(n: int, lengths: list[int]) -> None:
        room = capacity - sum(lengths)
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([n, lengths])

    rooms: list[int] = []
    for key, share in sorted(use.items(), key=lambda x: (-x[1], x[0])):
        lengths = sizes[list(key)].tolist()
        need = {s: lengths.count(s) for s in set(lengths)}
        n = min([int(share), *(left.get(s, 0) // k for s, k in need.items())])
        if n:
            keep(n, sorted(lengths, reverse=True))
            for s, k in need.items():
                left[s] -= n * k
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                k = min(capacity // s, n)
                keep(n // k, [s] * k)
                n -= n // k * k
                continue
            room = rooms[at]
            m, lengths = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            k = min(room // s, max(n // m, 1))
            used = min(m, n // k)
            if used < m:
                keep(m - used, lengths)
            keep(used, lengths + [s] * k)
            n -= used * k
    return made + [(n, lengths) for room in rooms for n, lengths in open_[room]]


def slots(made: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go by rank: from ``rank`` on, ``sequence`` counts up."""
    taken: dict[int, int] = {}
    found, sequence = [], 0
    for n, lengths in made:
        offset = 0
        for s in lengths:
            found.append((s, taken.get(s, 0), sequence, offset))
            taken[s] = taken.get(s, 0) + n
            offset += s
        sequence += n
    found.sort()
    names = ("length", "rank", "sequence", "offset")
    return dict(zip(names, np.array(found, dtype=np.int64).reshape(-1, 4).T))


# --- places of the pieces ----------------------------------------------------------------


def ranked(table: DataFrame, total: int) -> DataFrame:
    """``table`` with ``piece_rank``: 0, 1, ... among the rows of a length."""
    columns = [f"`{c}`" for c in table.columns]
    chunks = max(1, math.isqrt(total))
    dealt = table.withColumn("piece_chunk", F.pmod(F.xxhash64(*columns), F.lit(chunks)))
    counts = dealt.groupBy("length", "piece_chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("piece_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "piece_chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    inside = Window.partitionBy("length", "piece_chunk").orderBy(*columns)
    numbered = dealt.withColumn("row_in_chunk", F.row_number().over(inside))
    return numbered.join(starts, ["length", "piece_chunk"]).select(
        *columns, (F.col("first_rank") + F.col("row_in_chunk") - 1).alias("piece_rank"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (any table with a ``length`` of 1 to ``capacity``) with sequence_id and offset."""
    table = Written(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in
                 table.df.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = slots(plan(histogram, capacity, rounds))
    shared = table.df.sparkSession.sparkContext.broadcast(placed)

    def place(batches):
        s = shared.value
        shift = 1 << 44
        keys = s["length"] * shift + s["rank"]
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(names.index("piece_rank")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            kept = [batch.column(i) for i, c in enumerate(names) if c != "piece_rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(s["sequence"][at] + rank - s["rank"][at]), pa.array(s["offset"][at])],
                names=[c for c in names if c != "piece_rank"] + ["sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.df.schema)
    return ranked(table.df, sum(histogram.values())).mapInArrow(place, f"{fields}, sequence_id long, offset long")
