"""Lexicon files as DataFrames (A2-A4), and the bounded load for the labelers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slyglot.lexicons import INLINE_LIMIT, MIN_WORD_LENGTH, Lexicons

WHITESPACE = " \t\r\n\x0b\x0c"

SUBSTITUTION_SCHEMA = "character_substitutions map<string,string>"
HOMOPHONE_SCHEMA = "homophones map<string,array<string>>"
SPOONERISM_SCHEMA = (
    "spoonerisms array<struct<original: array<string>, spoonerism: array<string>>>"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def clean_words(lines: DataFrame, min_length: int = 1, column: str = "value") -> DataFrame:
    """Strip, lower-case, drop short entries, dedupe."""
    word = F.lower(strip(F.col(column)))
    return lines.select(word.alias("word")).filter(F.length("word") >= min_length).distinct()


def last_entry_wins(entries: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A3/A4: per key the last value, at the position of the first occurrence.

    The aggregate combines within each task before its shuffle, so a key that
    repeats in a third of the rows costs one row per task.
    """
    return entries.groupBy(key).agg(
        F.max_by(value, order).alias(value), F.min(order).alias("pos")
    )


def _lines(spark: SparkSession, path: str, schema: str, header_as_entry: bool, sep: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", not header_as_entry)
        .option("sep", sep)
        .option("quote", "")
        .csv(path)
    )


def read_words(
    spark: SparkSession, path: str, min_length: int = 1, header_as_entry: bool = True
) -> DataFrame:
    """A2: one-column list. By default a header line is an entry like any other.

    A list that cannot be read is empty.
    """
    try:
        lines = _lines(spark, path, "value string", header_as_entry, "\x01")
    except AnalysisException:
        lines = spark.createDataFrame([], "value string")
    return clean_words(lines, min_length)


def read_pairs(spark: SparkSession, path: str, header_as_entry: bool = True) -> DataFrame:
    """A3: ``domain,label`` list; the later of two equal domains wins.

    A list that cannot be read is empty.
    """
    try:
        lines = _lines(spark, path, "domain string, label string", header_as_entry, ",")
    except AnalysisException:
        return spark.createDataFrame([], "domain string, label string, pos struct<path: string, start: long, line: long>")
    line_order = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    entries = lines.select(
        strip(F.col("domain")).alias("domain"),
        strip(F.col("label")).alias("label"),
        line_order.alias("line"),
    )
    return last_entry_wins(entries, "domain", "label", "line")


def _read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A4: a whole-file JSON document; empty when the file cannot be read."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_substitutions(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``(source, target, pos)``. Spark keeps repeated JSON keys; the last wins."""
    entries = _read_json(spark, path, SUBSTITUTION_SCHEMA).select(
        F.posexplode("character_substitutions").alias("at", "source", "target")
    )
    return last_entry_wins(entries, "source", "target", "at")


def read_homophones(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``(word, variants, pos)``."""
    entries = _read_json(spark, path, HOMOPHONE_SCHEMA).select(
        F.posexplode("homophones").alias("at", "word", "variants")
    )
    return last_entry_wins(entries, "word", "variants", "at")


def read_spoonerisms(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``(o1, o2, s1, s2, pos)``. Entries that are no pairs match no two words and are left out."""
    return _read_json(spark, path, SPOONERISM_SCHEMA).select(
        F.posexplode("spoonerisms").alias("pos", "entry")
    ).filter("size(entry.original) = 2 AND size(entry.spoonerism) = 2").select(
        F.col("entry.original")[0].alias("o1"),
        F.col("entry.original")[1].alias("o2"),
        F.col("entry.spoonerism")[0].alias("s1"),
        F.col("entry.spoonerism")[1].alias("s2"),
        "pos",
    )


def bounded_rows(frame: DataFrame, limit: int = INLINE_LIMIT) -> list:
    """Rows of a small table on the driver. A longer one belongs in ``lexicon_tables``."""
    rows = frame.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(
            f"lexicon has more than {limit} rows; "
            "use slyglot.operators.lexicon_join with the DataFrame"
        )
    return rows


def lexicon_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All lexicon files of a folder as DataFrames, of any size, for ``lexicon_join``."""
    words = {"ts_words": "t-and-s-words.csv", "ts_domains": "t-and-s-domains.csv"}
    return {
        "harmful": read_words(spark, f"{folder}/harmful_words.txt", MIN_WORD_LENGTH),
        "substitutions": read_substitutions(spark, f"{folder}/char_substitutions.json"),
        "homophones": read_homophones(spark, f"{folder}/homophones.json"),
        "spoonerisms": read_spoonerisms(spark, f"{folder}/spoonerisms.json"),
        "news": read_pairs(spark, f"{folder}/news-domains.csv"),
        **{name: read_words(spark, f"{folder}/{file}") for name, file in words.items()},
    }


def load_lexicons(spark: SparkSession, folder: str) -> Lexicons:
    """All lexicon files of a folder, checked to be small enough to inline."""
    subs = bounded_rows(read_substitutions(spark, f"{folder}/char_substitutions.json"))
    homs = bounded_rows(read_homophones(spark, f"{folder}/homophones.json"))
    spoons = bounded_rows(read_spoonerisms(spark, f"{folder}/spoonerisms.json"))
    news = bounded_rows(read_pairs(spark, f"{folder}/news-domains.csv"))

    def word_list(name: str, length: int = 1) -> tuple[str, ...]:
        rows = bounded_rows(read_words(spark, f"{folder}/{name}", length))
        return tuple(sorted(r.word for r in rows))

    return Lexicons(
        harmful=word_list("harmful_words.txt", MIN_WORD_LENGTH),
        substitutions=tuple((r.source, r.target) for r in sorted(subs, key=lambda r: r.pos)),
        homophones=tuple((r.word, tuple(r.variants)) for r in sorted(homs, key=lambda r: r.pos)),
        spoonerisms=tuple(
            ((r.o1, r.o2), (r.s1, r.s2)) for r in sorted(spoons, key=lambda r: r.pos)
        ),
        ts_words=word_list("t-and-s-words.csv"),
        ts_domains=word_list("t-and-s-domains.csv"),
        news=tuple((r.domain, r.label) for r in sorted(news, key=lambda r: r.pos)),
    )
