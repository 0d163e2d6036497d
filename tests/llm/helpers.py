"""Small tables of texts for the corpus tests."""


LONG = "lang " * 60_000

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Documents from (doc_id, text[, source]) tuples."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(data, DOC_SCHEMA)


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "words without an id stand here"), (5, "same words twice"),
    (5, "same words twice"), (6, "same words twice"), (7, LONG), (8, "É ü ñ 日本 \u0000 \U0001f600"),
]


def clashing(df, names):
    """``df`` with columns that bear the names an operator gives its own."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


__all__ = ["DOC_SCHEMA", "LONG", "ODD", "clashing", "docs", "rows"]
