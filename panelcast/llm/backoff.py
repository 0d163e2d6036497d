"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

Documents are dealt to chunks by hash. A chunk explodes its n-grams of all orders, pre-aggregates
them and sends them to the hash-partitioned count table, one sorted block per shard; the shard
adds up the counts of all chunks and joins them back to every block; the chunk then sums the
scores of its documents. An n-gram crosses the network once per chunk that holds it, whatever
its frequency, so frequent ones make no hot key, and blocks need a third of the bytes of rows.

Score of a word: count(n-gram) / count(its context) for the longest n-gram that the table
holds, times ``ALPHA`` for each order given up; for the word alone count / words of the corpus.
N-grams of two words or more that occur once are not in the table: a text's own words would
vouch for themselves. An n-gram that is in the table has both its shorter parts there, so beyond
two words a chunk sends only n-grams whose parts came back as frequent; no count is lost.

Cases: a null or empty text has 0 words, log score 0 and no mean; null ids and repeated rows are
scored each, and repeated texts count each time; other columns are ignored; an empty table gives
an empty result. Texts of any length are scored whole.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 3
ALPHA = 0.4
LEAST_COUNT = 2
# Characters of text in a chunk and n-grams sent to a shard, on average.
CHUNK_CHARS = 3_000_000
SHARD_ENTRIES = 500_000
# Bits of a hash beyond those that count the corpus's n-grams: one n-gram in 2^25 shares its hash.
SPARE_BITS = 25
# Odd multipliers, one for each place in an n-gram of up to 64 words.
FACTORS = np.random.default_rng(17).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text)."""
    known, found, sizes = WordHashes(), [], []
    for text in texts:
        words = (text or b"").lower().split()  # on bytes both know ASCII only
        sizes.append(len(words))
        found.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
    return np.concatenate([np.empty(0, np.uint64), *found]), np.array(sizes, dtype=np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def ngrams(words: np.ndarray, sizes: np.ndarray, order: int, bits: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order (places of the last words, hashes of so many bits), without n-grams across texts."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = [(np.arange(len(words)), mixed(words + np.uint64(1)))]
    for n in range(2, order + 1):
        last = np.arange(n - 1, len(words))
        last = last[doc[last] == doc[last - (n - 1)]]
        h = np.full(len(last), n, dtype=np.uint64)
        for k in range(n):
            h += words[last - k] * FACTORS[k]
        out.append((last, mixed(h)))
    return [(last, h >> np.uint64(64 - bits)) for last, h in out]


def pack(values: np.ndarray, coded: int = 8) -> bytes:
    """Numbers as byte planes, no more of them than the largest needs; the highest ``coded`` planes,
    whose bytes repeat, are compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    plain = max(width - coded, 0)
    head = struct.pack("<BBI", width, plain, len(values))
    return head + planes[:plain].tobytes() + zlib.compress(planes[plain:].tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    width, plain, n = struct.unpack_from("<BBI", data)
    start = struct.calcsize("<BBI")
    planes = data[start:start + plain * n] + zlib.decompress(data[start + plain * n:])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return wide.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Steps between sorted numbers: their low bytes are noise, their highest ones repeat."""
    return pack(np.diff(values, prepend=np.uint64(0)), coded=1)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def bounds(hashes: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Where each shard's range of the sorted hashes begins, and the end."""
    edges = np.array([(k << bits) // shards for k in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def scores(grams: list, by_order: list[np.ndarray], total: int) -> np.ndarray:
    """Log score of every word from its counts of all orders."""
    n_words = len(by_order[0])
    out, given_up, done = np.zeros(n_words), np.zeros(n_words), np.zeros(n_words, dtype=bool)
    for n in range(len(grams), 1, -1):
        own, context = by_order[n - 1], np.concatenate([[1.0], by_order[n - 2][:-1]])
        exists = np.zeros(n_words, dtype=bool)
        exists[grams[n - 1][0]] = True
        use = ~done & (own >= LEAST_COUNT)
        out = np.where(use, np.log(np.where(use, own, 1.0) / np.where(use, context, 1.0)) + given_up, out)
        done |= use
        given_up = given_up + np.where(exists & ~done, math.log(ALPHA), 0.0)
    return np.where(done, out, np.log(np.maximum(by_order[0], 1) / max(total, 1)) + given_up)


def score(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    words = F.size(F.filter(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    size = docs.agg(F.sum(words.cast("long")).alias("words"), F.sum(F.octet_length(f"`{text}`")).alias("bytes")).first()
    total, n_chunks = size["words"] or 0, 1 + (size["bytes"] or 0) // CHUNK_CHARS
    shards = 1 + total * order // SHARD_ENTRIES
    bits = min(64, (total * order).bit_length() + SPARE_BITS)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))
    id_kind = rows.schema["doc_id"].dataType.simpleString()

    def shrink(batches):
        """Texts cross the network once and are read by every step; they take 0.43 of their size."""
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [None if t is None else small.compress(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)],
                                             names=["doc_id", "text", "chunk"])

    dealt = dealt.mapInArrow(shrink, f"doc_id {id_kind}, text binary, chunk long")

    def exploded(texts: list, order: int) -> tuple:
        whole = zstandard.ZstdDecompressor()
        words, sizes = word_hashes([None if t is None else whole.decompress(t) for t in texts])
        return words, sizes, ngrams(words, sizes, order, bits)

    def requests(chunk, hashes: np.ndarray) -> pa.Table:
        hashes, counts = np.unique(hashes, return_counts=True)
        edges = bounds(hashes, shards, bits)
        used = [k for k in range(shards) if edges[k + 1] > edges[k]]
        return pa.table({
            "shard": pa.array(used, pa.int64()), "chunk": pa.array([chunk] * len(used), pa.int64()),
            "hashes": pa.array([pack_sorted(hashes[edges[k]:edges[k + 1]]) for k in used], pa.binary()),
            "counts": pa.array([pack(counts[edges[k]:edges[k + 1]]) for k in used], pa.binary())})

    def counts_of(hashes: list[np.ndarray], replies: pa.Table, name: str) -> list[np.ndarray]:
        """Corpus counts of the n-grams that were asked for, in their places."""
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        by_shard = sorted((s, c) for s, k, c in zip(*(replies.column(x).to_pylist() for x in ("shard", "kind", "counts"))) if k == name)
        counts = np.concatenate([np.empty(0, np.uint64), *[unpack(c) for _, c in by_shard]]).astype(float)
        return np.split(counts[place], np.cumsum([len(h) for h in hashes])[:-1])

    def known_counts(words: np.ndarray, grams: list, replies: pa.Table, upto: int) -> list[np.ndarray]:
        """Corpus counts at every word, for orders 1 to ``upto``; 0 where the table has none."""
        out = []
        for (last, _), c in zip(grams, counts_of([h for _, h in grams[:2]], replies, "2")):
            out.append(np.zeros(len(words)))
            out[-1][last] = c
        for n in range(3, upto + 1):
            last, hashes = worth_asking(grams, out, n)
            out.append(np.zeros(len(words)))
            out[-1][last] = counts_of([hashes], replies, str(n))[0]
        return out

    def worth_asking(grams: list, counts: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """n-grams whose first and last n - 1 words are frequent."""
        last, hashes = grams[n - 1]
        part = counts[n - 2]
        use = (part[last] >= LEAST_COUNT) & (part[last - 1] >= LEAST_COUNT)
        return last[use], hashes[use]

    def ask(chunk: pa.Table) -> pa.Table:
        _, _, grams = exploded(chunk.column("text").to_pylist(), min(order, 2))
        return requests(chunk.column("chunk")[0].as_py(), np.concatenate([h for _, h in grams]))

    def ask_longer(n: int) -> Callable:
        def run(chunk: pa.Table, replies: pa.Table) -> pa.Table:
            words, _, grams = exploded(chunk.column("text").to_pylist(), n)
            wanted = worth_asking(grams, known_counts(words, grams, replies, n - 1), n)[1]
            return requests(chunk.column("chunk")[0].as_py(), wanted)

        return run

    def answer(shard: pa.Table, name: str) -> pa.Table:
        asked = [unpack_sorted(x) for x in shard.column("hashes").to_pylist()]
        known, place = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.concatenate([unpack(x) for x in shard.column("counts").to_pylist()])
        sums = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
        parts = np.split(sums[place], np.cumsum([len(x) for x in asked])[:-1])
        return pa.table({"chunk": shard.column("chunk"), "shard": shard.column("shard"),
                         "kind": pa.array([name] * shard.num_rows), "counts": pa.array([pack(x) for x in parts], pa.binary())})

    def add_up(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        words, sizes, grams = exploded(chunk.column("text").to_pylist(), order)
        each = scores(grams, known_counts(words, grams, replies, order), total)
        sums = np.add.reduceat(np.concatenate([each, [0.0]]), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        sums = np.where(sizes > 0, sums, 0.0)
        mean = [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist())]
        return pa.table({"doc_id": chunk.column("doc_id"), "n_words": pa.array(sizes), "log_score": pa.array(sums),
                         "mean_log_score": pa.array(mean, pa.float64())})

    asked_kind = "shard long, chunk long, hashes binary, counts binary"
    reply_kind = "chunk long, shard long, kind string, counts binary"

    def answers(asked: DataFrame, name: str) -> DataFrame:
        return asked.groupBy("shard").applyInArrow(lambda shard: answer(shard, name), reply_kind)

    chunks = dealt.groupBy("chunk")
    replies = answers(chunks.applyInArrow(ask, asked_kind), "2")
    for n in range(3, order + 1):
        longer = chunks.cogroup(replies.groupBy("chunk")).applyInArrow(ask_longer(n), asked_kind)
        replies = replies.unionByName(answers(longer, str(n)))
    return chunks.cogroup(replies.groupBy("chunk")).applyInArrow(
        add_up, f"doc_id {id_kind}, n_words long, log_score double, mean_log_score double")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS c, generate_subscripts(ws, 1) AS i FROM d),
p AS (SELECT rid, i, c, lag(c) OVER v AS b, lag(c, 2) OVER v AS a FROM w WINDOW v AS (PARTITION BY rid ORDER BY i)),
u AS (SELECT c, count(*) AS n FROM p GROUP BY c),
bi AS (SELECT b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY b, c),
tri AS (SELECT a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY a, b, c),
t AS (SELECT count(*) AS n FROM p),
s AS (SELECT p.rid, CASE WHEN tri.n >= {LEAST_COUNT} THEN ln(tri.n / ctx.n)
        WHEN bi.n >= {LEAST_COUNT} THEN ln(bi.n / ub.n) + CASE WHEN p.a IS NULL THEN 0 ELSE ln({ALPHA}) END
        ELSE ln(u.n / t.n) + CASE WHEN p.b IS NULL THEN 0 WHEN p.a IS NULL THEN ln({ALPHA}) ELSE 2 * ln({ALPHA}) END END AS x
      FROM p CROSS JOIN t JOIN u ON p.c = u.c LEFT JOIN u ub ON p.b = ub.c LEFT JOIN bi ON p.b = bi.b AND p.c = bi.c
      LEFT JOIN bi ctx ON p.a = ctx.b AND p.b = ctx.c LEFT JOIN tri ON p.a = tri.a AND p.b = tri.b AND p.c = tri.c),
g AS (SELECT rid, sum(x) AS x FROM s GROUP BY rid)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(x, 0), 4) AS log_score,
       round(CASE WHEN len(ws) > 0 THEN x / len(ws) END, 4) AS mean_log_score
FROM d LEFT JOIN g ON d.rid = g.rid"""
