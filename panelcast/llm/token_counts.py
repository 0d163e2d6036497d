"""Token counts per document by a two-tier lookup.

Tier one is a broadcast table of the corpus's frequent pieces with their token counts; tier
two is a cache in each Python worker, filled by the library for pieces the table lacks. Both
tiers hold what the library gives, so the counts are the library's whatever the tiers hold.
Pieces are never shuffled: tasks send bounded summaries of their most frequent ones.

Cases: a null or empty text has 0 bytes and 0 tokens; null ids and repeated rows are kept as
they are; other columns of the input are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tokens import BYTE_PIECES, BYTE_RUNS, LONGEST_CACHED, PLAIN, vocabulary, worker_encoder

# Pieces in the broadcast table: at most 32,768 of at most 64 characters.
TABLE_SIZE = 32_768
# Pieces a task keeps while it counts, and how many of them it sends.
TASK_KEEPS = 65_536
TASK_SENDS = 4_096


def frequent_pieces(docs: DataFrame, text: str = "text") -> list[str]:
    """The corpus's most frequent plain pieces, from every text; rarer ones may be missed."""

    def summary(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                plain = [value or ""]
                if not PLAIN.fullmatch(plain[0]):
                    plain = filter(PLAIN.fullmatch, BYTE_PIECES.findall(value))
                for part in plain:
                    runs = BYTE_RUNS.findall(part)
                    if max(map(len, runs), default=0) > LONGEST_CACHED:
                        runs = [r for r in runs if len(r) <= LONGEST_CACHED]
                    seen.update(runs)
                if len(seen) > 8 * TASK_KEEPS:
                    seen = Counter(dict(seen.most_common(TASK_KEEPS)))
        best = seen.most_common(TASK_SENDS)
        yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in best], "n": [n for _, n in best]},
                                         schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]))

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(summary, "piece string, n long")
    best = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(TABLE_SIZE)
    return [r["piece"] for r in best.collect()]


def count_tokens(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``."""
    frequent = frequent_pieces(docs, text)
    encoded = vocabulary(vocabulary_path).encode_batch_fast(frequent, add_special_tokens=False)
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, map(len, encoded))))

    def count(batches):
        n_tokens = worker_encoder("counts", vocabulary_path, pieces=BYTE_PIECES, runs=BYTE_RUNS, value=len, join=sum)
        n_tokens.runs.keep(table.value)

        for batch in batches:
            totals = [n_tokens(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
