"""Removal of lines that many sites share, on DataFrame functions alone.

Every line's hash gets a HyperLogLog sketch of the sites it stands on; sketches are made map-side
and merge by aggregation, so a line on every page of the corpus costs one sketch per task.
Where the estimate is near the threshold the sites are counted exactly; far from it the
estimate decides. Lines at the threshold or above are removed from every document.

Common lines are cut wherever they stand, on short pages too; only a text that has no other line
is left whole: such texts are copies of each other, and near-duplicate removal decides on them.

Cases: a null text is read as empty; blank lines are never removed; a null site adds nothing
to the spread; null ids and repeated rows are treated like any other; other columns are
ignored (``clean``) or kept (``deduplicate``), whatever their names and types; an empty table
gives an empty result. Lines and texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tables import Written

# White space that is cut from the ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
# A line on so many sites is boilerplate.
MIN_SITES = 5
# Sketch of 2^12 registers: about 1.6 % error; estimates within 20 % of the threshold, and at
# least one site, are counted exactly.
REGISTERS = 12
BAND = 0.2


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line): hashes on at least ``min_sites`` sites; ``lines`` has columns line and site."""
    near = max(1.0, BAND * min_sites)
    sketched = lines.groupBy("line").agg(F.hll_sketch_agg("site", REGISTERS).alias("sketch"))
    estimated = Written(
        sketched.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - near),
        "line_spread").df
    close = estimated.where(F.col("sites") <= min_sites + near).select("line")
    exact = (lines.join(close, "line").select("line", "site").where("site is not null").distinct()
             .groupBy("line").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    return estimated.where(F.col("sites") > min_sites + near).select("line").unionByName(exact.select("line"))


def without(lines: Column, places: Column) -> Column:
    """``lines`` without those at ``places`` (ascending, from 0): the stretches between them."""
    before = F.concat(F.array(F.lit(-1)), places)
    behind = F.concat(places, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, behind, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def cut_lines(docs: DataFrame, keep: list[str], doc_id: str, text: str, site: str, min_sites: int) -> DataFrame:
    """(row, text, n_lines, n_removed) of every row of ``docs``; row has the columns ``keep``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
                       F.coalesce(f"`{text}`", F.lit("")).alias("text"), F.col(f"`{site}`").cast("string").alias("site"))
    placed = rows.select("doc_id", "site", F.xxhash64("text").alias("body"),
                         F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = Written(placed.where(bare(F.col("line")) != "").select(
        "doc_id", "body", "site", "at", F.xxhash64(bare(F.col("line"))).alias("line")), "lines").df
    common = spread_lines(lines, min_sites)
    # Where a text has common lines depends on the text alone: one row for repeated rows.
    hits = (lines.join(common, "line").groupBy("doc_id", "body", "at").agg(F.lit(1))
            .groupBy("doc_id", "body").agg(F.array_sort(F.collect_list("at")).alias("hits")))
    d, h = rows.withColumn("body", F.xxhash64("text")).alias("d"), hits.alias("h")
    joined = d.join(h, F.col("d.body").eqNullSafe(F.col("h.body")) & F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), "left")
    n_lines = F.size(F.filter(F.split("text", "\n"), lambda line: bare(line) != ""))
    counted = joined.select("row", "text", "hits", n_lines.cast("long").alias("n_lines"))
    cut = F.col("hits").isNotNull() & (F.size("hits") < F.col("n_lines"))
    # The split text is bound to a name, so that it is split once and not for every stretch.
    rest = F.transform(F.array(F.split("text", "\n")), lambda split: F.array_join(without(split, F.col("hits")), "\n"))[0]
    return counted.select(
        "row", F.when(cut, rest).otherwise(F.col("text")).alias("text"), "n_lines",
        F.when(cut, F.size("hits")).otherwise(0).cast("long").alias("n_removed"))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
          min_sites: int = MIN_SITES) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every row of ``docs``; n_lines counts lines with text."""
    return cut_lines(docs, [doc_id], doc_id, text, site, min_sites).select(
        F.col(f"row.`{doc_id}`").alias("doc_id"), "text", "n_lines", "n_removed")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the common lines cut from ``text``; rows and other columns stay."""
    done = cut_lines(docs, [c for c in docs.columns if c != text], doc_id, text, site, min_sites)
    return done.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
e AS (SELECT rid, doc_id, source, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
n AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM e),
b AS (SELECT bare FROM n WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT n.*, b.bare IS NOT NULL AS hit FROM n LEFT JOIN b ON n.bare = b.bare),
g AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) FILTER (bare <> '') AS n_lines,
             count(*) FILTER (hit) AS hits,
             string_agg(line, chr(10) ORDER BY pos) AS whole,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS rest
      FROM m GROUP BY rid)
SELECT doc_id, CASE WHEN hits > 0 AND hits < n_lines THEN rest ELSE whole END AS text, n_lines,
       CASE WHEN hits > 0 AND hits < n_lines THEN hits ELSE 0 END AS n_removed
FROM g"""
