"""Column expressions over post text. All are built-in JVM expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.lexicons import MIN_WORD_LENGTH

# The protocol's URL and type formats.
POST_URL_PREFIX = "https://bsky.app/profile/"
IMAGE_URL_PREFIX = "https://cdn.bsky.app/img/feed_thumbnail/plain/"
EMBED_IMAGES_TYPE = "app.bsky.embed.images"

# Letters, numbers and underscore of any script. Java's own \w is ASCII only.
WORD_CHAR = r"[\p{L}\p{N}_]"


def compile_substitutions(entries) -> list[tuple]:
    """Turn ordered replacements into as few ``translate``/``replace`` steps as possible.

    Applying the steps equals replacing each entry in turn. One-to-one character
    entries merge into a single translate, also across a replace they do not touch;
    an entry whose text can no longer occur is dropped.
    """
    steps: list[tuple] = []

    def gone(char: str) -> bool:
        absent = False
        for step in steps:
            if step[0] == "translate":
                absent = (absent or char in step[1]) and char not in step[1].values()
            else:
                absent = absent and char not in step[2]
        return absent

    for old, new in entries:
        if not old:
            raise ValueError("a substitution needs a non-empty source")
        if old == new or any(gone(c) for c in old):
            continue
        if len(old) > 1 or len(new) != 1:
            steps.append(("replace", old, new))
            continue
        at = len(steps) - 1
        while at >= 0 and steps[at][0] == "replace":
            _, other_old, other_new = steps[at]
            if old in other_old or old in other_new or new in other_old:
                break
            at -= 1
        if at >= 0 and steps[at][0] == "translate":
            table = steps[at][1]
            for key, value in table.items():
                if value == old:
                    table[key] = new
            table.setdefault(old, new)
        else:
            steps.append(("translate", {old: new}))
    return steps


def normalize(text: Column, substitutions) -> Column:
    """B1: lower-case, then undo look-alike characters in list order."""
    out = F.lower(text)
    for kind, *args in compile_substitutions(substitutions):
        if kind == "translate":
            table = {k: v for k, v in args[0].items() if k != v}
            out = F.translate(out, "".join(table), "".join(table.values()))
        else:
            out = F.replace(out, F.lit(args[0]), F.lit(args[1]))
    return out


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A later filter on an ordinary derived column is pushed below it, and the column's
    expression is then run by the filter and again by the projection. A one-row
    ``inline`` keeps such filters above it; filters on other columns still pass.
    """
    made = F.struct(*(c.alias(name) for name, c in columns.items()))
    return frame.select("*", F.inline(F.array(made)))


def words(text: Column) -> Column:
    """B2: all word runs, in order."""
    return F.regexp_extract_all(text, F.lit(f"({WORD_CHAR}++)"), 1)


def long_words(tokens: Column, length: int = MIN_WORD_LENGTH) -> Column:
    """Words of at least ``length`` characters."""
    return F.filter(tokens, lambda w: F.length(w) >= length)


def has_two_long_words(tokens: Column) -> Column:
    return F.size(long_words(tokens)) >= 2


def char_similarity(left: Column, right: Column) -> Column:
    """``1 - edits/longest``; 0 for an empty word or a length gap over 2."""
    gap = F.abs(F.length(left) - F.length(right))
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(
        (F.length(left) == 0) | (F.length(right) == 0) | (gap > 2), F.lit(0.0)
    ).otherwise(F.lit(1.0) - F.levenshtein(left, right) / longest)


def code_similarity(left: Column, right: Column) -> Column:
    """Share of equal positions of two codes; 0 when either is empty."""
    pairs = F.zip_with(F.split(left, ""), F.split(right, ""), lambda a, b: (a == b).cast("int"))
    matches = F.aggregate(pairs, F.lit(0), lambda n, hit: n + F.coalesce(hit, F.lit(0)))
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(
        (F.length(left) > 0) & (F.length(right) > 0), matches / longest
    ).otherwise(F.lit(0.0))


def best_code_similarity(left: list[Column], right: list[Column]) -> Column:
    """Best similarity over every pair of a word's codes and another word's codes."""
    scores = [code_similarity(a, b) for a in left for b in right]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def any_adjacent(tokens: Column, condition) -> Column:
    """True when ``condition(a, b)`` holds for some neighbours ``a, b``."""
    following = F.slice(tokens, 2, F.size(tokens))
    return F.exists(F.zip_with(tokens, following, condition), lambda hit: hit)


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs as structs ``(a, b)``; the last word starts no pair."""
    following = F.slice(tokens, 2, F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.filter(pairs, lambda p: p["b"].isNotNull())


def swap_initials(a: Column, b: Column) -> tuple[Column, Column]:
    """Both words with their first letters exchanged."""
    return (
        F.concat(F.left(b, F.lit(1)), F.substring(a, 2, 2_147_483_647)),
        F.concat(F.left(a, F.lit(1)), F.substring(b, 2, 2_147_483_647)),
    )


def path_part(url: Column, position: int) -> Column:
    """Slash-separated part counted from the end (-1 is the last); NULL if absent."""
    return F.try_element_at(F.split(url, "/"), F.lit(position))


def post_handle(url: Column) -> Column:
    """The handle in a post URL."""
    return path_part(url, -3)


def post_rkey(url: Column) -> Column:
    """The record key in a post URL."""
    return path_part(url, -1)


def did_from_uri(uri: Column) -> Column:
    """The account identifier in a record URI."""
    return path_part(uri, -3)


def post_url(handle: Column, uri: Column) -> Column:
    """Public URL of a post from its author's handle and record URI."""
    return F.concat(F.lit(POST_URL_PREFIX), handle, F.lit("/post/"), path_part(uri, -1))


def image_ref_cid(ref: Column) -> Column:
    """Content id from whichever member of the reference union is set."""
    return F.coalesce(ref["link"], F.decode(ref["bytes"], "UTF-8"), ref["str"])


def image_url(did: Column, cid: Column) -> Column:
    """Thumbnail URL of an image."""
    return F.concat(F.lit(IMAGE_URL_PREFIX), did, F.lit("/"), cid, F.lit("@jpeg"))


def is_image_embed(embed: Column) -> Column:
    """Whether an embed holds images; a missing embed does not."""
    return F.coalesce(embed["py_type"] == EMBED_IMAGES_TYPE, F.lit(False))


def labels_to_json(labels: Column) -> Column:
    """Label list as JSON text."""
    return F.to_json(labels)


def labels_from_json(text: Column) -> Column:
    """Inverse of :func:`labels_to_json`."""
    return F.from_json(text, "array<string>")


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
