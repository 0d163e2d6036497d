"""Lines on many sites go, others stay."""

from helpers import LONG, ODD, clashing, docs, rows
from oracle_check import compare, connect

from panelcast.llm import line_dedup


def body(i):
    return f"own words of page {i} that stand nowhere else and are long enough"


def test_common_lines_go(spark):
    texts = [(i, f"{body(i)}\n  menu and so on \n{body(-i)}", f"s{i}") for i in range(1, 6)]
    got = rows(line_dedup.clean(docs(spark, texts)), "doc_id", "text", "n_lines", "n_removed")
    assert got == [(i, f"{body(i)}\n{body(-i)}", 3, 1) for i in range(1, 6)]


def test_below_the_threshold_nothing_goes(spark):
    texts = [(i, f"{body(i)}\nmenu", f"s{min(i, 4)}") for i in range(1, 9)]
    assert all(r.n_removed == 0 for r in line_dedup.clean(docs(spark, texts)).collect())


def test_sites_that_are_null_do_not_count(spark):
    texts = [(i, f"{body(i)}\nmenu", f"s{i}" if i < 5 else None) for i in range(1, 12)]
    assert all(r.n_removed == 0 for r in line_dedup.clean(docs(spark, texts)).collect())


def test_far_above_the_threshold_the_sketch_decides(spark):
    texts = [(i, f"{body(i)}\nmenu", f"s{i}") for i in range(300)]
    assert all(r.n_removed == 1 for r in line_dedup.clean(docs(spark, texts)).collect())


def test_copies_are_left_whole(spark):
    text = "\n".join(body(k) for k in range(4))
    texts = [(i, text, f"s{i}") for i in range(8)]
    assert {r.text for r in line_dedup.clean(docs(spark, texts)).collect()} == {text}


def test_odd_documents(spark):
    table = docs(spark, [*ODD, (20, "\n\n" + "line " * 9 + "\n\n"), (21, "x\n" * 5000 + LONG)])
    got = rows(line_dedup.clean(clashing(table, ["at", "line", "hits", "body", "n_lines"])), "doc_id", "text")
    assert got == sorted(((r.doc_id, r.text or "") for r in table.collect()), key=repr)


def test_repeated_rows_and_null_ids(spark):
    texts = [(k, f"{body(7)}\nmenu", f"s{i}") for i in range(6) for k in (None, 3)]
    got = rows(line_dedup.clean(docs(spark, texts)), "doc_id", "n_removed")
    # Both lines are common, so the rows are copies and stay whole.
    assert got == sorted([(None, 0)] * 6 + [(3, 0)] * 6, key=repr)
    texts += [(50 + i, f"{body(i)}\nmenu", f"s{i}") for i in range(6)] + [(50, f"{body(0)}\nmenu", "s0")]
    got = rows(line_dedup.clean(docs(spark, texts)).where("doc_id >= 50"), "doc_id", "text")
    assert got == sorted([(50 + i, body(i)) for i in range(6)] + [(50, body(0))])


def test_empty_table(spark):
    table = docs(spark, ODD).where("false")
    assert line_dedup.clean(table).count() == 0
    assert line_dedup.deduplicate(table).columns == table.columns


def test_deduplicate_keeps_columns(spark):
    table = clashing(docs(spark, [(i, f"{body(i)}\nmenu", f"s{i}") for i in range(6)]), ["row", "hits", "n_removed"])
    got = line_dedup.deduplicate(table)
    assert got.columns == table.columns
    assert rows(got, "doc_id", "text", "source", "hits") == [(i, body(i), f"s{i}", "clash") for i in range(6)]


def test_deduplicate_cuts_common_lines_from_short_pages(spark):
    """Most of the page is boilerplate; only a text of nothing else is left whole."""
    common = "\n".join(f"a long line of the site's frame, number {k}, that stands on every page" for k in range(4))
    texts = [(i, f"{common}\nown {i}", f"s{i}") for i in range(6)] + [(6, common, "s6")]
    got = rows(line_dedup.deduplicate(docs(spark, texts)), "doc_id", "text")
    assert got == [(i, f"own {i}") for i in range(6)] + [(6, common)]


def test_short_pages_lose_a_common_first_line(spark):
    texts = [(i, f"the line that stands first on every page of every site\nown {i}", f"s{i % 6}") for i in range(30)]
    got = rows(line_dedup.clean(docs(spark, texts)), "doc_id", "text", "n_lines", "n_removed")
    assert got == sorted(((i, f"own {i}", 2, 1) for i in range(30)), key=repr)


def test_any_type_of_other_column(spark):
    from pyspark.sql import functions as F

    texts = [(i, f"{body(i)}\nmenu", f"s{i}") for i in range(6)]
    table = docs(spark, texts).withColumns({"tags": F.create_map(F.lit("k"), F.col("doc_id")), "list": F.array("source")})
    got = line_dedup.deduplicate(table)
    assert got.schema == table.schema
    assert sorted((r.doc_id, r.text, r.tags) for r in got.collect()) == [(i, body(i), {"k": i}) for i in range(6)]


def test_a_text_of_very_many_common_lines(spark):
    many = [f"common {k}" for k in range(100_000)]
    texts = [(i, "\n".join(many) + f"\nown {i}\n", f"s{i}") for i in range(5)]
    got = rows(line_dedup.clean(docs(spark, texts)), "doc_id", "text", "n_lines", "n_removed")
    assert got == [(i, f"own {i}\n", 100_001, 100_000) for i in range(5)]


def test_corpus_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    from panelcast.llm.queries import ORACLES, QUERIES

    for name in ("op6_line_dedup", "op5_lm_scoring"):
        assert compare(connect(folder), QUERIES[name](spark, folder), ORACLES[name])[0] == "ok"
