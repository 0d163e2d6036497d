"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least ``2 * q`` long, that no
neighbouring word extends. At every dyadic scale t a synchronising set holds positions that the
next ``2 * t`` words alone decide: position i belongs to it if, among the windows of t words that
start at i to i + t and are not highly periodic (period above t / 3), the one of least hash
starts at i or at i + t. Equal stretches therefore hold the same positions, and every t positions
hold one unless the words there are highly periodic.

1. Periods 1 and 2 are found by comparing neighbours.
2. Periods q with ``3 * t <= q < 6 * t`` come from pairs of positions of the set of scale t with
   equal contexts of ``2 * t`` words at a distance in that range. A run of such a period holds
   a pair at distance q, unless it is highly periodic nearly everywhere.
3. Such a run consists of two highly periodic regions of one small period that touch, and a
   region is a run of a smaller scale, known by then. Touching regions propose the distances at
   which their phases agree.

Each proposal is extended both ways as far as the words agree, which gives its exact run.
Windows are named by doubling (equal names exactly for equal words), so nothing rests on hashes
but the choice of positions. A task works on groups of texts with numpy; the positions of a
set that share a context thin out with the scale, so a group of n words costs O(n log n).

Cases: a null or empty text has no run and an empty rest; null ids and repeated rows are kept
as they are; among proposals with equal ends the smallest period counts; other columns are
ignored, whatever their names; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
# Words of the texts that are searched together; a longer text is searched by itself.
GROUP_WORDS = 200_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# --- names and extensions ----------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one hash of 64-bit numbers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def name_windows(words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(names, repeated positions) of the windows of 1, 2, 4, ... words, up to the first scale without repeats.

    Windows have equal names exactly if their words are equal.
    """
    n = len(words)
    repeated = np.bincount(words, minlength=n)[words] > 1
    levels = [(words, np.flatnonzero(repeated))]
    while len(levels[-1][1]):
        names, places = levels[-1]
        step = 1 << (len(levels) - 1)
        left = places[places + step < n]
        left = left[repeated[left + step]]
        key = names[left].astype(np.int64) * (int(names.max()) + 1) + names[left + step]
        # Most windows are unique: a table of counts by hash finds nearly all of them.
        slots = 1 << max(10, len(key).bit_length() + 1)
        slot = (mixed(key) & np.uint64(slots - 1)).astype(np.int64)
        likely = np.bincount(slot, minlength=slots)[slot] > 1
        left, key = left[likely], key[likely]
        _, label, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count > 1
        classes = int(often.sum())
        kept = often[label]
        left = left[kept]
        longer = np.arange(classes, classes + n, dtype=np.int64)
        longer[left] = (np.cumsum(often) - 1)[label[kept]]
        repeated = np.zeros(n, bool)
        repeated[left] = True
        levels.append((longer, left))
    return levels


def agree_after(levels: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i and from j on are equal."""
    same = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k][0]
        same += (names[i + same] == names[j + same]).astype(np.int64) << k
    return same


def agree_before(levels: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before i and before j are equal."""
    same = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k][0]
        a, b = i - same - (1 << k), j - same - (1 << k)
        same += ((a >= 0) & (names[np.maximum(a, 0)] == names[np.maximum(b, 0)])).astype(np.int64) << k
    return same


# --- proposals ---------------------------------------------------------------------------


def neighbour_runs(words: np.ndarray, period: int) -> np.ndarray:
    """(start, end, period) rows of the stretches of a small period, twice its length or more."""
    same = np.concatenate([[False], words[:-period] == words[period:], [False]]).astype(np.int8)
    change = np.diff(same)
    start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = stop - start >= period
    return np.stack([start[long], stop[long] + period, np.full(int(long.sum()), period)], axis=1)


def set_positions(names: np.ndarray, scale: int, known: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set of a scale among ``within`` (whole texts, ascending)."""
    if scale == 1:  # of two neighbouring windows one is the least: every position belongs
        return within
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    value = mixed(names[within])
    flat = known[(3 * known[:, 2] <= scale) & (known[:, 1] - known[:, 0] >= scale)]
    if len(flat):
        depth = np.zeros(len(names) + 1, np.int64)
        np.add.at(depth, flat[:, 0], 1)
        np.add.at(depth, flat[:, 1] - scale + 1, -1)
        value[np.cumsum(depth)[within] > 0] = top
    least, width = value, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    m = len(least)
    chosen = (least != top) & ((value[:m] == least) | (value[scale:scale + m] == least))
    return within[:m][chosen]


def context_pairs(contexts: np.ndarray, places: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of places with equal contexts, three to six scales apart."""
    order = np.argsort(contexts[places], kind="stable")
    place, context = places[order], contexts[places][order]
    index, j = np.arange(len(place)), 0
    at, distance = [], []
    while True:
        j += 1
        index = index[index + j < len(place)]
        gap = place[index + j] - place[index]
        close = (context[index + j] == context[index]) & (gap < 6 * scale)
        index, gap = index[close], gap[close]
        if not len(index):
            break
        far = gap >= 3 * scale
        at.append(place[index[far]])
        distance.append(gap[far])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *at]), np.concatenate([empty, *distance])


def touching_regions(levels: list, known: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) at which touching highly periodic regions of one period agree."""
    regions = known[(3 * known[:, 2] <= scale) & (known[:, 1] - known[:, 0] >= 3 * scale)]
    regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    one, two = regions[:-1], regions[1:]
    touch = (one[:, 2] == two[:, 2]) & (two[:, 0] <= one[:, 1])
    at, distance = [], []
    for (x1, y1, p), (x2, y2, _) in zip(one[touch].tolist(), two[touch].tolist()):
        phase = x1 + np.arange(p)
        equal = np.flatnonzero(agree_after(levels, phase, np.full(p, x2)) >= p)
        if len(equal):
            most = min(y1 - x1, y2 - x2, (y2 - x1) // 2, 6 * scale - 1)
            first = 3 * scale + (x2 - x1 - int(equal[0]) - 3 * scale) % p
            q = np.arange(first, most + 1, p)
            at.append(np.maximum(x1, x2 - q))
            distance.append(q)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *at]), np.concatenate([empty, *distance])


def find_runs(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """(start, end, period) rows of all runs, at least two periods long.

    ``words`` holds the texts one after the other, each with numbers of its own, and a number
    that occurs once before, between and after them; ``text_of`` gives a position's text.
    """
    found = neighbour_runs(words, 1)
    # Between words, every stretch of period 1 has period 2 as well, with the same ends.
    found = first_of_ends(np.concatenate([found, neighbour_runs(words, 2)]), len(words))
    levels = name_windows(words)
    for k, (contexts, places) in enumerate(levels[1:]):
        scale = 1 << k
        if not len(places):
            break
        alive = np.zeros(int(text_of[-1]) + 1, bool)
        alive[text_of[places]] = True
        chosen = set_positions(levels[k][0], scale, found, np.flatnonzero(alive[text_of]))
        repeated = np.zeros(len(words), bool)
        repeated[places] = True
        pairs = context_pairs(contexts, chosen[repeated[chosen]], scale)
        more = touching_regions(levels, found, scale)
        at, distance = (np.concatenate(x) for x in zip(pairs, more))
        if len(at):
            before, after = agree_before(levels, at, at + distance), agree_after(levels, at, at + distance)
            long = before + after >= distance
            new = np.stack([at - before, at + distance + after, distance], axis=1)[long]
            found = first_of_ends(np.concatenate([found, new]), len(words))
    return found


def first_of_ends(runs: np.ndarray, n: int) -> np.ndarray:
    """One row for each start and end, with the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0] * (n + 1) + runs[:, 1]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[fresh]


# --- texts -------------------------------------------------------------------------------


def search(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """Per text, a list of words: its runs (start, length, period) and the words that stay.

    A word goes if any run contains it after that run's first period.
    """
    numbers, starts, at, high = [np.zeros(1, np.int64)], [], 1, 1
    for words in texts:
        table = {w: k for k, w in enumerate(dict.fromkeys(words), high)}
        starts.append(at)
        high += len(table) + 1
        numbers.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        numbers.append(np.array([high - 1]))
        at += len(words) + 1
    sequence = np.concatenate(numbers)
    text_of = np.repeat(np.arange(len(texts) + 1), [1, *[len(w) + 1 for w in texts]])
    runs = find_runs(sequence, text_of)
    runs = runs[runs[:, 1] - runs[:, 0] >= min_words]
    depth = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    stays = np.cumsum(depth) == 0
    of: dict[int, list[tuple[int, int, int]]] = {}
    for start, end, period in runs[np.lexsort((runs[:, 2], runs[:, 0]))].tolist():
        text = int(text_of[start]) - 1
        of.setdefault(text, []).append((start - starts[text], end - start, period))
    out = []
    for k, words in enumerate(texts):
        if k in of:
            kept = np.flatnonzero(stays[starts[k]:starts[k] + len(words)])
            out.append((of[k], [words[i] for i in kept.tolist()]))
        else:
            out.append(([], words))
    return out


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, runs, text) of every row of ``docs``.

    ``runs`` is an array of (start, length, period) by start, then period; ``text`` holds the
    words outside repetitions, joined by one space.
    """

    def groups(batches):
        ids, words, size = [], [], 0
        for batch in batches:
            kind = batch.column(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids.append(name)
                words.append((value.as_py() or b"").split())  # bytes split at ASCII white space only
                size += len(words[-1]) + 1
                if size >= GROUP_WORDS:
                    yield kind, ids, words
                    ids, words, size = [], [], 0
        if ids:
            yield kind, ids, words

    def run(batches):
        for kind, ids, words in groups(batches):
            found = search(words, min_words)
            flat = [dict(zip(("start", "length", "period"), r)) for runs, _ in found for r in runs]
            ends = np.cumsum([0, *[len(runs) for runs, _ in found]])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, kind), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, RUN)),
                pa.array([b" ".join(kept) for _, kept in found], pa.binary()).cast(pa.string()),
            ], names=["doc_id", "runs", "text"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    of_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {of_id}, runs array<struct<start:long,length:long,period:long>>, text string")


def plant(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs`` where every tenth text, by its id's checksum, repeats from some word on.

    With h the checksum of the id, g = h div 10 and n words: from word a = g mod n on, the text
    repeats the p = 1 + (n - a) div (3 + g mod 8) words that stand there, up to n words. A null
    id has no checksum, and its text stays.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    g = F.floor(h / 10).cast("long")
    marked = rows.withColumns({"chosen": h % 10 == 0, "g": g, "n": F.size(words)}).withColumns({
        "chosen": F.col("chosen") & (F.col("n") > 0), "a": F.col("g") % F.greatest("n", F.lit(1))})
    rest = (F.col("n") - F.col("a")).cast("int")
    p = (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")
    period = F.slice(words, (F.col("a") + 1).cast("int"), p)
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a").cast("int")), tail), " ")
    return marked.select("doc_id", F.when(F.col("chosen"), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The runs of ``periodic_runs`` as counts, the longest run and checksums."""
    key = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period")))
    longest = found.withColumn("best", F.array_min(key))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.shortness")).alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * -F.col("best.shortness") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
