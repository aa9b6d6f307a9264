"""Labelers: ``DataFrame -> DataFrame`` functions that add a ``labels`` column.

Use with ``posts.transform(label_evasion)`` on a batch or a streaming DataFrame.
All are narrow: they add columns within the stage that scans the posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.functions.phonetic import skeleton_key
from slyglot.lexicons import (
    CHARSUB_LABEL,
    GENERAL_LABEL,
    HOMOPHONE_LABEL,
    IMAGE_LABEL,
    SPOONERISM_LABEL,
    TS_LABEL,
    Lexicons,
)
from slyglot.operators import detect as D

WORK_COLUMNS = ("raw_words", "raw_score", "norm_words")


def with_raw_words(posts: DataFrame, lex: Lexicons, text: str = "text") -> DataFrame:
    """Add the words of the text and their context score, each computed once."""
    out = T.once(posts, raw_words=T.words(F.lower(text)))
    return T.once(out, raw_score=D.context_score(F.col("raw_words"), lex.context))


def with_norm_words(posts: DataFrame, lex: Lexicons, text: str = "text") -> DataFrame:
    """Add the words of the text with look-alike characters undone."""
    return T.once(posts, norm_words=T.words(T.normalize(F.col(text), lex.substitutions)))


def with_norm_score(posts: DataFrame, lex: Lexicons) -> DataFrame:
    """Add the context score of the normalised words."""
    return T.once(posts, norm_score=D.context_score(F.col("norm_words"), lex.context))


def evasion_labels(charsub: Column, homophone: Column, spoonerism: Column) -> Column:
    """Specific labels in fixed order, then the general one if there are any."""
    return F.array_compact(
        F.array(
            F.when(charsub, F.lit(CHARSUB_LABEL)),
            F.when(homophone, F.lit(HOMOPHONE_LABEL)),
            F.when(spoonerism, F.lit(SPOONERISM_LABEL)),
            F.when(charsub | homophone | spoonerism, F.lit(GENERAL_LABEL)),
        )
    )


def with_evasion_flags(
    posts: DataFrame, lex: Lexicons | None = None, phonetic: bool = True, text: str = "text", key=skeleton_key, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Add boolean columns ``charsub``, ``homophone`` and ``spoonerism``.

    With ``phonetic`` off, homophones come from the dictionary only. ``key`` gives the
    codes of a word from built-in expressions, so the whole plan stays in the JVM.
    Of the columns worked with, those in ``keep`` stay.
    """
    lex = lex or Lexicons()
    raw, score = F.col("raw_words"), F.col("raw_score")
    flags = {
        "charsub": D.charsub(F.col("norm_words"), lex),
        "homophone": D.homophone(raw, score, lex, key) if phonetic else D.homophone_dictionary(raw, score, lex),
        "spoonerism": D.spoonerism(raw, score, lex),
    }
    out = with_norm_words(with_raw_words(posts, lex, text), lex, text)
    return T.once(out, **flags).drop(*(c for c in WORK_COLUMNS if c not in keep))


def label_evasion(
    posts: DataFrame, lex: Lexicons | None = None, phonetic: bool = True, text: str = "text", key=skeleton_key
) -> DataFrame:
    """Add ``labels`` for disguised harmful language. A NULL text gets ``[]``."""
    flagged = with_evasion_flags(posts, lex, phonetic, text, key)
    labels = evasion_labels(F.col("charsub"), F.col("homophone"), F.col("spoonerism"))
    return flagged.withColumn("labels", labels).drop("charsub", "homophone", "spoonerism")


def with_lowered(posts: DataFrame, text: str = "text") -> DataFrame:
    """Add the lower-cased text once; the substring tests all read this column."""
    return posts.withColumn("lowered", F.lower(text))


def text_labels(lowered: Column, lex: Lexicons) -> Column:
    """The T&S label, then citation labels in list order."""
    is_ts = D.contains_any(lowered, (*lex.ts_words, *lex.ts_domains))
    ts = F.when(is_ts, F.array(F.lit(TS_LABEL)))
    return F.concat(safe_labels(ts), safe_labels(D.pair_labels(lowered, lex.news)))


def with_image_label(labels: Column, image_match: Column) -> Column:
    """Labels followed by the image label where an image matched."""
    image = F.when(image_match, F.array(F.lit(IMAGE_LABEL)))
    return F.concat(labels, safe_labels(image))


def with_text_labels(posts: DataFrame, lex: Lexicons, text: str = "text") -> DataFrame:
    """Add ``text_labels``, computed once."""
    lowered = with_lowered(posts, text)
    return T.once(lowered, text_labels=text_labels(F.col("lowered"), lex)).drop("lowered")


def label_basic(posts: DataFrame, image_match: Column, lex: Lexicons | None = None) -> DataFrame:
    """D18 over posts that carry an image-match flag (see ``hashmatch``)."""
    out = with_text_labels(posts, lex or Lexicons())
    return out.withColumn("labels", with_image_label(F.col("text_labels"), image_match)).drop("text_labels")


def safe_labels(labels: Column) -> Column:
    """A post that could not be labelled has no labels."""
    return F.coalesce(labels, F.array().cast("array<string>"))
