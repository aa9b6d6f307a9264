"""Small tables with the awkward rows every operator must take."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, h string"


def documents(spark, texts):
    """A documents table with ids from 0 and extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", len(t or ""), 0.5, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows."""
    docs = documents(spark, ["", " \n\t", "one two three four five six", "one two three four five six", "ab " * 60_000, "x" * 200_000, None, "né ß 日本 😀"])
    nulls = spark.createDataFrame([(None,) * 7, (2, "one two three four five six", None, None, None, None, None)], DOC_SCHEMA)
    return docs.union(nulls)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
