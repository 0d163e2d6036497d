"""Merkle manifest of a table: leaf, subroot, root and proof of every row, by bitmap ranks.

Leaves of a group ascend by key; every three nodes in a row become one, level by level, up to
the group's subroot, and the subroots in the order of their groups become the root likewise.

Where a leaf stands is its key's rank, and ranks come from bitmaps instead of a sort of rows:

1. Keys of a group are set bits in words of 64, made map-side and merged by ``bit_or``; words
   without a key do not exist, so the bitmap takes space by its keys.
2. A directory of counts holds how many rows stand before each word: sums inside containers of
   512 words, on top of running sums over containers.
3. A row's rank is its word's entry plus the set bits below its own.

A word's count above its set bits tells that keys repeat in it; such rows, and those without a
key, are ranked among themselves by leaf, by ranges if they are many.

Nodes are then reduced in blocks of 243 slots keyed by rank, five levels at a time: a block is an
array that one row of a grouping holds, whatever the size of its group. Paths are read off
from the blocks on the way back down, joined by (group, block), so no join or grouping has a
key of more than 243 rows.

Cases: a null group is a group and comes first; null keys come first in their group; rows with
equal key are ordered by leaf, and equal leaves change places freely; a group of one row has
its leaf for a subroot and a table of one group its subroot for a root; columns of the result's
names are not read unless they are named; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.tables import Written
from panelcast.operators.ranking import running_total

FAN = 3
# Levels reduced at once, and the slots of a block.
LEVELS = 5
SLOTS = FAN**LEVELS
# The columns of a document in the order they are hashed.
DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]
# Bits that number a key inside its word, and a word inside its container.
WORD_BITS, CONTAINER_BITS = 6, 9
# The word of rows without a key, below all others.
NO_KEY = -(1 << 63)


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_of(values: list[Column]) -> Column:
    """Hash of a row: each value as its byte count, a colon and itself, a dash for null."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


# --- ranks -------------------------------------------------------------------------------


def from_bit(value: int) -> Column:
    """``value`` moved up to the key's bit in its word: 1 is that bit, -1 all bits from it on."""
    place = F.col("key").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(value).cast("long"), place)


def directory(leaves: DataFrame) -> DataFrame:
    """(group, word, bits, n, first): set bits and rows of each word, and rows of the group before it.

    ``leaves`` has columns group, word and key.
    """
    words = Written(leaves.groupBy("group", "word").agg(F.bit_or(from_bit(1)).alias("bits"), F.count(F.lit(1)).alias("n"))
                    .withColumn("container", F.shiftright("word", CONTAINER_BITS)), "bitmap_words")
    sizes = Written(words.df.groupBy("group", "container").agg(F.sum("n").alias("n")), "containers")
    upto = running_total(sizes.df, ["group"], "container", F.col("n"), "upto")
    starts = Written(upto.select("group", "container", (F.col("upto") - F.col("n")).alias("start")), "container_starts")
    inside = Window.partitionBy("group", "container").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    counted = words.df.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    made = Written(counted.join(starts.df, ["group", "container"]).select(
        "group", "word", "bits", "n", (F.col("start") + F.col("inside")).alias("first")), "directory")
    for table in (words, sizes, starts):
        table.drop()
    return made.df


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, word, leaf, row and others) with ``rank``: 0, 1, ... in each group."""
    entries = directory(leaves)
    repeated = F.col("bits").isNull() | (F.bit_count("bits") < F.col("n"))
    names = [*leaves.columns, "rank"]
    single = leaves.join(entries.where(~repeated), ["group", "word"]).withColumn(
        "rank", F.col("first") + F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(from_bit(-1))))).select(*names)
    again = entries.where(repeated)
    if again.isEmpty():
        return single
    tied = Written(leaves.join(again.select("group", "word", "first"), ["group", "word"]).withColumn(
        "place", F.struct(F.coalesce("key", F.lit(0)).alias("key"), "leaf", "row")), "repeated_keys")
    placed = running_total(tied.df, ["group", "word"], "place", F.lit(1), "upto")
    return single.unionByName(placed.withColumn("rank", F.col("first") + F.col("upto") - 1).select(*names))


# --- blocks ------------------------------------------------------------------------------


def level_up(nodes: Column) -> Column:
    """Every three nodes in a row become one."""
    return F.transform(F.sequence(F.lit(0), (F.ceil(F.size(nodes) / FAN) - 1).cast("int")),
                       lambda i: digest(F.array_join(F.slice(nodes, FAN * i + 1, F.lit(FAN)), "")))


def reduce_blocks(items: DataFrame) -> DataFrame:
    """(group, block, rows, levels) of items (group, rank, node, payload).

    ``rows`` has (node, payload) by slot, ``levels`` the nodes of each level. Only the first
    block of a group can be its last level; others always have five levels above them.
    """
    filled = items.groupBy("group", F.floor(F.col("rank") / SLOTS).alias("block")).agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("rank") % SLOTS).cast("int").alias("slot"), F.struct("node", "payload").alias("row")))).alias("slots"))
    rows = filled.select("group", "block", F.transform(
        F.sequence(F.lit(0), F.size("slots") - 1), lambda s: F.element_at("slots", s)).alias("rows"))

    def grown(levels: Column, _) -> Column:
        last = F.element_at(levels, -1)
        return F.when((F.col("block") > 0) | (F.size(last) > 1), F.concat(levels, F.array(level_up(last)))).otherwise(levels)

    leaves = F.array(F.transform("rows", lambda r: r["node"]))
    return rows.withColumn("levels", F.aggregate(F.array(*[F.lit(k) for k in range(LEVELS)]), leaves, grown))


def siblings(levels: Column, slot: Column) -> Column:
    """(before, after) of the run's other nodes on each level, joined, from the slot upwards."""
    powers = F.array(*[F.lit(FAN**k) for k in range(LEVELS)])

    def on_level(nodes: Column, k: Column) -> Column:
        at = F.floor(slot / F.element_at(powers, k + 1)).cast("int")
        return F.struct(F.array_join(F.slice(nodes, at - at % FAN + 1, at % FAN), "").alias("before"),
                        F.array_join(F.slice(nodes, at + 2, FAN - 1 - at % FAN), "").alias("after"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), on_level)


def climb(items: DataFrame) -> tuple[list[Written], DataFrame]:
    """The blocks of every round, lowest first, and (group, node) with each group's top node."""
    rounds = []
    while True:
        rounds.append(Written(reduce_blocks(items), "merkle_blocks"))
        items = rounds[-1].df.select("group", F.col("block").alias("rank"), F.element_at("levels", -1)[0].alias("node"),
                                     F.lit(None).cast("string").alias("payload"))
        if items.where("rank > 0").isEmpty():
            return rounds, items.select("group", "node")


def descend(rounds: list[Written], tops: DataFrame, carried: list[str]) -> DataFrame:
    """(group, node, payload, path, carried columns) of the lowest round's rows.

    ``tops`` has (group, path, carried columns): the path from a group's top node upwards.
    """
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        joined = blocks.df.join(above.withColumnRenamed("path", "upper"), ["group", "block"])
        rows = F.transform("rows", lambda r, s: F.struct(
            (F.col("block") * SLOTS + s).alias("rank"), r["node"].alias("node"), r["payload"].alias("payload"),
            F.concat(siblings(F.col("levels"), s), F.col("upper")).alias("path")))
        found = joined.select("group", F.inline(rows), *carried)
        above = found.select("group", F.col("rank").alias("block"), "path", *carried)
    return found.drop("rank")


# --- the manifest ------------------------------------------------------------------------


def manifest(rows: DataFrame, key: str, group: str, leaf: str, keep: list[str]) -> DataFrame:
    """(``keep`` columns, leaf, subroot, root, path) of every row of ``rows``.

    ``key`` is an integer column, ``leaf`` a column of row hashes. ``path`` holds the siblings
    on every level up to the root as (before, after), see ``fold`` and ``proof``.
    """
    # Groups as text that is never null and keeps their order, null first.
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    number = F.col(f"`{key}`").cast("long")
    leaves = Written(rows.select(
        named.alias("group"), number.alias("key"), F.coalesce(F.shiftright(number, WORD_BITS), F.lit(NO_KEY)).alias("word"),
        F.col(f"`{leaf}`").alias("leaf"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("payload"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    low, subroots = climb(ranked(leaves.df).select("group", "rank", F.col("leaf").alias("node"), "payload"))
    subroots = Written(subroots, "subroots")
    ordered = running_total(subroots.df, [], "group", F.lit(1), "upto").select(
        F.lit("").alias("group"), (F.col("upto") - 1).alias("rank"), "node", F.col("group").alias("payload"))
    high, root = climb(ordered)
    no_path = F.array().cast("array<struct<before:string,after:string>>")
    of_groups = descend(high, root.select("group", F.col("node").alias("root"), no_path.alias("path")), ["root"])
    tops = Written(of_groups.select(F.col("payload").alias("group"), "path", F.col("node").alias("subroot"), "root"), "group_paths")
    found = descend(low, tops.df, ["subroot", "root"])
    return found.select("payload.*", F.col("node").alias("leaf"), "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["before"], node, p["after"])))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` by source, and whether rows with line breaks cut out still lead to the root.

    Half of the documents, by the checksum of their id, are folded without their line breaks.
    """
    columns = [F.col(c) for c in DOCUMENT]
    cut = [F.replace(c, F.lit("\n"), F.lit("")) if name == "text" else c for name, c in zip(DOCUMENT, columns)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select("doc_id", "source", leaf_of(columns).alias("leaf"), F.when(chosen, leaf_of(cut)).alias("tampered"))
    found = manifest(rows, "doc_id", "source", "leaf", ["doc_id", "tampered"])
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree(name: str, leaves: str) -> str:
    """Common table expressions: ``name`` has (g, lvl, pos, node) of all levels, ``name``_sib each node's siblings."""
    return f"""
{name}(g, lvl, pos, node) AS (
  {leaves}
  UNION ALL
  SELECT g, lvl + 1, pos // {FAN}, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {name}) WHERE c > 1 GROUP BY g, lvl, pos // {FAN}),
{name}_top AS (SELECT g, max(lvl) AS top, arg_max(node, lvl) AS node FROM {name} GROUP BY g),
{name}_sib AS (
  SELECT n.g, n.lvl, n.pos, coalesce(string_agg(n.node, '' ORDER BY n.pos) OVER (
           PARTITION BY n.g, n.lvl, n.pos // {FAN} ORDER BY n.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(n.node, '' ORDER BY n.pos) OVER (
           PARTITION BY n.g, n.lvl, n.pos // {FAN} ORDER BY n.pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} n JOIN {name}_top t ON t.g = n.g AND n.lvl < t.top)"""


def _hashed(columns: list[str]) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns) + ")"


# The checksum of an id, bit by bit: SQL has no function for it.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE = f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, {_hashed(DOCUMENT)} AS leaf,
             CASE WHEN {_CRC} % 2 = 0 THEN {_hashed([*DOCUMENT[:-1], "replace(text, chr(10), '')"])} END AS tampered
      FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_tree("low", "SELECT g, 0, pos, leaf FROM p")},
s AS (SELECT g AS source, node AS subroot, top, row_number() OVER (ORDER BY g) - 1 AS place FROM low_top),
{_tree("high", "SELECT '', 0, place, subroot FROM s")},
steps AS (
  SELECT p.rid, x.lvl AS k, x.before, x.after FROM p JOIN low_sib x ON x.g = p.g AND x.pos = p.pos // ({FAN} ** x.lvl)::BIGINT
  UNION ALL
  SELECT p.rid, s.top + x.lvl, x.before, x.after FROM p JOIN s ON s.source = p.g
  JOIN high_sib x ON x.pos = s.place // ({FAN} ** x.lvl)::BIGINT),
proofs AS (SELECT rid, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM steps GROUP BY rid),
fold(rid, k, node) AS (
  SELECT rid, 0, coalesce(tampered, leaf) FROM p
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(x.before || f.node || x.after) FROM fold f JOIN steps x ON x.rid = f.rid AND x.k = f.k),
folded AS (SELECT rid, arg_max(node, k) AS node FROM fold GROUP BY rid)
SELECT p.doc_id, p.leaf, s.subroot, r.node AS root, coalesce(proofs.proof, sha256('')) AS proof_sha256,
       folded.node AS folded_root, folded.node = r.node AS verified
FROM p JOIN s ON s.source = p.g CROSS JOIN high_top r JOIN folded USING (rid) LEFT JOIN proofs USING (rid)"""
