"""Lexicon preparation C1-C7 on DataFrames, for lexicons of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.functions.phonetic import codes_of, skeleton_key
from slyglot.lexicons import HIGH_CONFIDENCE_LENGTH, MIN_WORD_LENGTH
from slyglot.sources.lexicon_files import clean_words


def harmful_lexicon(lines: DataFrame, column: str = "value") -> DataFrame:
    """Entries of at least the minimum length."""
    return clean_words(lines, MIN_WORD_LENGTH, column)


def high_confidence(lexicon: DataFrame) -> DataFrame:
    """The longer entries."""
    return lexicon.filter(F.length("word") >= HIGH_CONFIDENCE_LENGTH)


def by_length(lexicon: DataFrame) -> DataFrame:
    """The length key. Buckets stay rows; none is collected into one value."""
    return lexicon.withColumn("len", F.length("word"))


def homophone_lookup(entries: DataFrame) -> DataFrame:
    """C4: ``(token, related)`` in both directions from ``(word, variant)`` rows."""
    way = lambda token, related: F.struct(token.alias("token"), related.alias("related"))
    word, variant = F.col("word"), F.col("variant")
    both = F.explode(F.array(way(word, variant), way(variant, word))).alias("p")
    return entries.select(both).select("p.token", "p.related").distinct()


def spoonerism_lookup(entries: DataFrame) -> DataFrame:
    """Swapped pair to original pair, the last listed one, from ``(o1, o2, s1, s2, pos)``."""
    last = F.max_by(F.struct("o1", "o2"), "pos").alias("original")
    return entries.groupBy("s1", "s2").agg(last).select("s1", "s2", "original.*")


def phonetic_vocabulary(vocabulary: DataFrame, key=skeleton_key) -> DataFrame:
    """Both codes of each distinct word, by any key function, or from a table of known codes.

    The table is ``(word, primary, secondary)``, of any size. A word that it lacks has no
    code and sounds like nothing; of several rows for a word the least one counts.
    """
    words = vocabulary.select("word").distinct()
    if isinstance(key, DataFrame):
        codes = [F.coalesce(name, F.lit("")).alias(name) for name in ("primary", "secondary")]
        known = key.groupBy("word").agg(F.min(F.struct(*codes)).alias("key"))
        return words.join(known, "word").select("word", "key.primary", "key.secondary")
    return words.withColumn("key", key(F.col("word"))).select("word", "key.primary", "key.secondary")


def phonetic_index(lexicon: DataFrame, key=skeleton_key) -> DataFrame:
    """``(code, word)`` rows for both codes of each word, empty codes skipped."""
    keys = phonetic_vocabulary(lexicon, key)
    return keys.select(F.explode(codes_of(F.struct("primary", "secondary"))).alias("code"), "word")


def reverse_substitutions(entries: DataFrame) -> DataFrame:
    """``(target, source)`` rows, one per pair, keyed by what the source stands for."""
    return entries.select("target", "source").distinct()


def disguised_pieces(posts: DataFrame, substitutions, text: str = "text") -> DataFrame:
    """``(word, variant)``: space-separated pieces that normalise to something else."""
    piece = F.explode(F.array_distinct(F.split(F.lower(text), r"\s+"))).alias("variant")
    word = T.normalize(F.col("variant"), substitutions)
    return (
        posts.select(piece)
        .distinct()
        .withColumn("word", word)
        .filter((F.length("word") > 0) & (F.col("word") != F.col("variant")))
    )
