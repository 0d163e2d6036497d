"""Manifest against plain Python and its SQL twin, with odd keys, groups and sizes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import DOC_SCHEMA, ODD, clashing, docs
from oracle_check import compare, connect
from pyspark.sql import functions as F

from panelcast.llm import merkle
from panelcast.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i - i % 3
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 3])))
        i //= 3
    return out


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].replace("\n", "")))
            for before, after in path:
                node = h(before + node + after)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOC_SCHEMA)
    assert result(merkle.verified_documents(df)) == brute(rows)


def test_query_equals_plain_python(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*merkle.DOCUMENT)
    want = brute([tuple(r) for r in table.collect()])
    assert result(QUERIES["op13_merkle_manifest"](spark, FOLDER)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_query_equals_its_sql_twin(spark):
    df = QUERIES["op13_merkle_manifest"](spark, FOLDER)
    assert compare(connect(FOLDER), df, ORACLES["op13_merkle_manifest"])[0] == "ok"


def test_odd_documents(spark):
    rows = [(i, "src0", "en", len(t or ""), t) for i, t in ODD]
    table = clashing(docs(spark, ODD), ["group", "rank", "node", "payload", "leaf", "word", "root", "path"])
    assert result(merkle.verified_documents(table)) == brute(rows)
    assert merkle.verified_documents(table.where("false")).count() == 0


def test_sizes_around_runs_and_blocks(spark):
    rows = []
    for k, n in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 242, 243, 244, 486, 729, 730, 1000]):
        rows += [(1000 * k + i, f"s{k:02d}", "en", i, f"a\n{i}") for i in range(n)]
    random.Random(1).shuffle(rows)
    check(spark, rows)


def test_many_groups(spark):
    check(spark, [(i, f"host{i % 700}", "en", i, "x") for i in range(1500)])


def test_null_repeated_negative_and_far_keys(spark):
    keys = [None, None, None, 5, 5, 5, 6, -1, -64, -65, -(1 << 63), (1 << 63) - 1, 0, 63, 64, 32767, 32768, 1 << 40]
    rows = [(key, source, None, k % 2 or None, f"t{k % 3}\n") for k, key in enumerate(keys) for source in (None, "", "a", "É", "日")]
    rows += rows[:20]  # whole rows twice
    check(spark, rows)


def test_one_key_on_many_rows(spark, monkeypatch):
    # Ranks of equal keys are cut into ranges when they are many.
    import panelcast.operators.ranking as ranking

    monkeypatch.setattr(ranking.running_total, "__defaults__", (50,))
    check(spark, [(7, "a", "en", i, f"text {i % 150}") for i in range(600)] + [(None, "a", "en", i, "x") for i in range(300)])


def test_any_columns_of_another_table(spark):
    table = spark.range(500).select((F.col("id") * 3).alias("number"), (F.col("id") % 4).alias("part"),
                                    merkle.leaf_of([F.col("id")]).alias("hash"))
    found = merkle.manifest(table, "number", "part", "hash", ["number"])
    checked = found.select("number", (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert len(checked) == 500 and all(r.ok for r in checked)


@pytest.mark.parametrize("value, text", [(None, "-"), ("", "0:"), ("é", "2:é")])
def test_values_are_told_apart(spark, value, text):
    got = spark.createDataFrame([(value,)], "v string").select(merkle.leaf_of([F.col("v")])).first()[0]
    assert got == h(text)
