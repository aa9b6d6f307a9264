"""Lexicon matching as joins, for lexicons of any size.

Work goes in two steps. The distinct vocabulary of the posts is matched with the lexicon
by equi-joins on keys that cannot miss a match; then one narrow pass over the posts probes
the words that matched. The lexicon is measured first and broadcast only while it is
small; a larger one joins by sorted shuffle, with the same rows. The side made from texts
is never the one that is built, whatever size Spark estimates for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.functions.phonetic import skeleton_key
from slyglot.lexicons import (
    CHARSUB_LABEL,
    CHARSUB_THRESHOLD,
    HOMOPHONE_LABEL,
    IMAGE_LABEL,
    MIN_CONTEXT,
    MIN_WORD_LENGTH,
    PHONETIC_THRESHOLD,
    SHORT_WORD_LENGTH,
    SHORT_WORD_PENALTY,
    SPECIFIC_LABELS,
    SPOONERISM_LABEL,
    TS_LABEL,
    Lexicons,
)
from slyglot.operators import anchors
from slyglot.operators import detect as D
from slyglot.operators import labelers as L
from slyglot.operators.lexicon_prep import phonetic_vocabulary
from slyglot.session import scratch_path

#: Edits up to which words are keyed by what is left without some letters.
DELETED = 2
#: Patterns beyond so many characters take more text along than the others.
LONG_PATTERN = 64
#: A lexicon is broadcast up to so many rows and characters; its keys are a few times as many.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 4_000_000
#: Patterns that every text is searched for one by one at most.
INLINE_PATTERNS = 256
#: Anchors that are tested as a set within the text scan at most; more go into a Bloom filter.
INLINE_ANCHORS = 10_000


def is_small(lexicon: DataFrame) -> bool:
    """Whether a lexicon may be broadcast. Counts its rows and characters: one job on it alone."""
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in lexicon.columns), F.lit(0))
    found = lexicon.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("chars")).first()
    return found.n <= BROADCAST_ROWS and found.chars <= BROADCAST_CHARS


def build_side(frame: DataFrame, small: bool) -> DataFrame:
    """The lexicon side of a join: built if small, else joined by sorted shuffle."""
    return F.broadcast(frame) if small else frame.hint("merge")


def settled(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written to the shared scratch folder and read again.

    Runs the first of the two steps now. What is read back has a known size, so Spark
    broadcasts it in the second step only under its own limit.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def post_tokens(
    posts: DataFrame, tokens: str, gate: Column | None = None, key: str = "post_id"
) -> DataFrame:
    """Distinct long words of each post that passes ``gate``; no shuffle.

    The gate empties the array instead of filtering the post.
    """
    distinct = F.array_distinct(T.long_words(F.col(tokens)))
    if gate is not None:
        distinct = F.when(gate, distinct)
    return _exploded(posts, distinct, key).withColumnRenamed("value", "word")


def _exploded(posts: DataFrame, values: Column, key: str) -> DataFrame:
    """``(key, value)``, the array computed once: Spark also asks of what is exploded whether it is empty."""
    return T.once(posts, _values=values).select(key, F.explode("_values").alias("value"))


def posts_with_words(tokens: DataFrame, matched: DataFrame, key: str = "post_id") -> DataFrame:
    """Ids of posts that have any matched word.

    Hand in a ``settled`` table, or a lexicon as ``build_side``, to keep the tokens from
    being shuffled.
    """
    return tokens.join(matched, "word", "left_semi").select(key).distinct()


def _threshold(length: str, base: float) -> str:
    short = base + SHORT_WORD_PENALTY
    return f"IF({length} < {SHORT_WORD_LENGTH}, {short!r}D, {base!r}D)"


def _allowed(longest: str, threshold: str, score: str) -> str:
    """Most differences (``n``) for which ``score`` still reaches the threshold."""
    return f"array_max(filter(sequence(0, {longest}), n -> {score} >= {threshold}))"


def _segments(text: str, length: str, count: str, shift: str, key: str) -> str:
    """Keys for each shift of each of ``count`` even pieces of a word of ``length``."""
    start = f"(i * {length} DIV {count})"
    size = f"((i + 1) * {length} DIV {count} - {start})"
    return (
        f"flatten(transform(sequence(0, {count} - 1), i -> transform({shift}, d -> "
        f"IF({start} + d >= 0, {key.format(part=f'substring({text}, {start} + d + 1, {size})')}, NULL))))"
    )


def _with_deletions(frame: DataFrame, name: str, most: str) -> DataFrame:
    """``(name, h)``: hashes of a word with any ``most`` letters, or fewer, left out.

    ``most`` is an SQL expression of 0 to ``DELETED``.
    """
    cut = lambda w: f"transform(sequence(1, length({w})), i -> concat(substring({w}, 1, i - 1), substring({w}, i + 1)))"
    cuts = frame.select(name, F.expr(f"{most} AS most")).withColumn("one", F.expr(f"IF(most > 0, {cut(name)}, array())"))
    cuts = cuts.withColumn("two", F.expr(f"IF(most > 1, flatten(transform(one, v -> {cut('v')})), array())"))
    made = F.array_distinct(F.transform(F.concat(F.array(name), "one", "two"), lambda v: F.xxhash64(v)))
    return cuts.filter("most > 0").select(name, F.explode(made).alias("h"))


def fuzzy_words(vocabulary: DataFrame, lexicon: DataFrame) -> DataFrame:
    """D4 at scale: vocabulary words close, but not equal, to a lexicon word.

    Two words within ``k`` edits are alike after ``k`` letters, or fewer, are left out of
    each. Up to ``DELETED`` edits both sides are keyed by all such remainders, which are
    nearly whole words, so no key is common. Longer words may differ in more: a word
    within ``k`` edits of another contains one of its ``k + 1`` even pieces unchanged, moved
    by at most ``k``, and then pieces are long.
    """
    bounds = lexicon.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    shortest, longest = (bounds[0] or 0), (bounds[1] or 0)
    threshold = _threshold("l", CHARSUB_THRESHOLD)
    edits = f"CAST({_allowed('l + 1', threshold, '1.0D - n / (l + 1)')} AS INT)"
    near = f"filter(array(length(word) - 1, length(word), length(word) + 1), l -> l BETWEEN {shortest} AND {longest})"

    words = vocabulary.select("word").distinct().filter(
        F.length("word").between(max(shortest - 1, MIN_WORD_LENGTH), longest + 1)
    )
    targets = lexicon.select(F.col("word").alias("target")).distinct()
    small = is_small(targets)
    few = "IF(k > %d, 0, k)" % DELETED
    of_word = f"coalesce(array_max(transform(transform({near}, l -> {edits}), k -> {few})), 0)"
    of_target = f"element_at(transform(transform(array(length(target)), l -> {edits}), k -> {few}), 1)"
    pairs = _with_deletions(words, "word", of_word).join(
        build_side(_with_deletions(targets, "target", of_target), small), "h").select("word", "target")

    key = "named_struct('l', l, 'i', i, 'part', {part})"

    def keyed(frame: DataFrame, name: str, lengths: str, shift: str) -> DataFrame:
        # l and k are bound once per target length
        pieces = (
            f"flatten(transform({lengths}, l -> flatten(transform(filter(array({edits}), k -> k > {DELETED}), "
            f"k -> {_segments(name, 'l', '(k + 1)', shift, key)}))))"
        )
        return (
            frame.select(name, F.explode(F.array_distinct(F.array_compact(F.expr(pieces)))).alias("p"))
            .select(name, "p.l", "p.i", "p.part")
        )

    most = lexicon.select(F.expr(f"max(element_at(transform(array(length(word)), l -> {edits}), 1))").alias("k")).first().k or 0
    if most > DELETED:
        long_words = keyed(words, "word", near, "sequence(-k, k)")
        long_targets = build_side(keyed(targets, "target", "array(length(target))", "array(0)"), small)
        pairs = pairs.union(long_words.join(long_targets, ["l", "i", "part"]).select("word", "target"))
    similarity = T.char_similarity(F.col("word"), F.col("target"))
    wanted = F.expr(_threshold("length(target)", CHARSUB_THRESHOLD))
    alike = (F.col("word") != F.col("target")) & (F.abs(F.length("word") - F.length("target")) <= 1)
    return pairs.filter(alike & (similarity >= wanted)).select("word").distinct()


def phonetic_words(vocabulary: DataFrame, lexicon: DataFrame, key=skeleton_key) -> DataFrame:
    """D7 at scale: vocabulary words that sound like a lexicon word other than themselves.

    ``key`` is any function from a word column to two codes, a UDF included: it sees each
    distinct word once. Or it is a table ``(word, primary, secondary)`` of known codes.

    Codes agreeing at all but ``m`` of ``n`` positions share one of ``m + 1`` even
    pieces in place. With ``m = 0`` that is equality of the whole code.
    """
    classes = {
        "short": PHONETIC_THRESHOLD + SHORT_WORD_PENALTY,
        "long": PHONETIC_THRESHOLD,
    }

    def keyed(frame: DataFrame, name: str, codes: str, word_classes: Column) -> DataFrame:
        piece = "named_struct('cls', cls, 'n', n, 'i', i, 'part', {part})"
        limit = "CASE cls " + " ".join(f"WHEN '{c}' THEN {t!r}D" for c, t in classes.items()) + " END"
        misses = f"array_max(filter(sequence(0, n), x -> (n - x) / n >= {limit}))"
        pieces = (
            "flatten(transform(sequence(length(code), length(code) + length(code) DIV 4 + 1), "
            f"n -> flatten(transform(filter(array({misses}), m -> n - length(code) <= m), "
            f"m -> {_segments('code', 'n', '(m + 1)', 'array(0)', piece)}))))"
        )
        return (
            phonetic_vocabulary(frame, key)
            .select("word", F.explode(F.array_distinct(F.array("primary", "secondary"))).alias("code"))
            .filter(F.length("code") > 0)
            .withColumn("cls", F.explode(word_classes))
            .select(
                F.col("word").alias(name),
                F.col("code").alias(codes),
                F.explode(F.array_compact(F.expr(pieces))).alias("p"),
            )
            .select(name, codes, "p.cls", "p.n", "p.i", "p.part")
        )

    own_class = F.when(F.length("word") < SHORT_WORD_LENGTH, F.array(F.lit("short"))).otherwise(
        F.array(F.lit("long"))
    )
    both = F.array(*(F.lit(c) for c in classes))
    words = vocabulary.select("word").filter(F.length("word") >= MIN_WORD_LENGTH)
    similarity = T.code_similarity(F.col("code"), F.col("target_code"))
    wanted = F.when(F.col("cls") == "short", F.lit(classes["short"])).otherwise(
        F.lit(classes["long"])
    )
    return (
        keyed(words, "word", "code", both)
        .join(
            build_side(keyed(lexicon, "target", "target_code", own_class), is_small(lexicon.select("word"))),
            ["cls", "n", "i", "part"],
        )
        .filter((F.col("word") != F.col("target")) & (similarity >= wanted))
        .select("word")
        .distinct()
    )


def substring_hits(posts: DataFrame, patterns: DataFrame, key: str | list[str] = "post_id") -> DataFrame:
    """D13-D15 at scale: distinct ``(post_id, pattern)`` where the text contains the pattern.

    A few patterns are simply searched for in the scan. A longer list is searched through
    its anchors (see ``anchors``): the rarest q-gram of each pattern, by a sample of the
    texts. The scan tests all positions against a filter of the anchors, and only those
    that pass become rows that meet the patterns in a join on the anchors' hashes. Patterns longer than
    ``LONG_PATTERN`` are a kind of their own, so that they do not widen the text that goes
    with the others. The rows are the same.
    """
    keys = [key] if isinstance(key, str) else key
    return lowered_hits(posts.select(*keys, F.lower("text").alias("lowered")), patterns, keys)


def lowered_hits(lowered: DataFrame, patterns: DataFrame, keys: list[str]) -> DataFrame:
    """``substring_hits`` of ``(keys, lowered)``, texts that are in lower case already."""
    patterns = patterns.select("pattern").filter(F.length("pattern") > 0).distinct()
    few = patterns.limit(INLINE_PATTERNS + 1).collect()
    if len(few) <= INLINE_PATTERNS:
        listed = F.array(*(F.lit(p.pattern) for p in few)).cast("array<string>")
        found = F.filter(listed, lambda p: F.contains(F.col("lowered"), p))
        return lowered.select(*keys, F.explode(found).alias("pattern")).distinct()
    long = (F.length("pattern") > LONG_PATTERN).cast("int").alias("kind")
    placed = settled(anchors.anchored(patterns, lowered.select(F.col("lowered").alias("text"))).select("*", long), "anchors")
    small = is_small(placed.select("pattern"))
    longest: dict[int, dict[int, int]] = {0: {}, 1: {}}
    for r in placed.groupBy("kind", "q").agg(F.max(F.length("pattern")).alias("longest")).collect():
        longest[r.kind][r.q] = r.longest
    nothing = anchors.AnchorFilter([])
    wanted = [
        (anchors.anchor_filter(placed.filter(F.col("kind") == kind), INLINE_ANCHORS) if longest[kind] else nothing, longest[kind])
        for kind in (0, 1)
    ]
    at = anchors.stands(lowered.filter(F.length("lowered") > 0), keys, wanted)
    side = build_side(placed.select("kind", F.col("gram").alias("anchor"), "pattern"), small)
    return at.join(side, ["kind", "anchor"]).filter(F.contains("around", "pattern")).select(*keys, "pattern").distinct()


def cited_labels(posts: DataFrame, entries: DataFrame, key: str = "post_id") -> DataFrame:
    """D15 at scale: ``(post_id, labels)`` of every post, in list order, without repeats.

    ``entries`` is ``(pos, pattern, label)`` of any size. A post has at most one entry of
    each label, so its list is bounded by the labels, not by the hits.
    """
    hits = substring_hits(posts, entries, key)
    by_pattern = entries.select("pos", "pattern", "label")
    first = (
        hits.join(build_side(by_pattern, is_small(by_pattern)), "pattern")
        .groupBy(key, "label").agg(F.min("pos").alias("pos"))
        .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "label"))).alias("found"))
    )
    return posts.select(key).join(first, key, "left").select(
        key, L.safe_labels(F.transform("found", lambda f: f["label"])).alias("labels")
    )


def label_basic_join(
    posts: DataFrame, ts_patterns: DataFrame, entries: DataFrame, matched: DataFrame, key: str = "post_id"
) -> DataFrame:
    """D18 for lists of any size: ``(post_id, labels)`` of every post.

    Labels are the T&S one, those of citations in list order without repeats, and the
    image one. ``ts_patterns`` is ``(pattern)``, ``entries`` is ``(pos, pattern, label)``,
    and ``matched`` has the ids of posts with a matching image. The texts are searched
    once for both lists. What is gathered for a post is bounded by the labels.
    """
    ts = ts_patterns.select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), "pattern", F.lit(TS_LABEL).alias("label"))
    listed = ts.union(entries.select(F.lit(1), F.col("pos").cast("long"), "pattern", "label")).distinct()
    hits = substring_hits(posts, listed, key).join(build_side(listed, is_small(listed)), "pattern")
    in_text = hits.groupBy(key, "part", "label").agg(F.min("pos").alias("pos"))
    in_images = matched.select(key).distinct().select(key, F.lit(2), F.lit(IMAGE_LABEL), F.lit(0).cast("long"))
    found = in_text.union(in_images).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("part", "pos", "label"))).alias("found"))
    return posts.select(key).join(found, key, "left").select(
        key, L.safe_labels(F.transform("found", lambda f: f["label"])).alias("labels")
    )


def ts_posts(posts: DataFrame, patterns: DataFrame, key: str = "post_id") -> DataFrame:
    """D13/D14 at scale: ids of posts that contain any pattern."""
    return substring_hits(posts, patterns, key).select(key).distinct()


def match_keys(posts: DataFrame, lex: Lexicons, key: str = "post_id", kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Everything about a post that a lexicon can match, as ``(post_id, kind, key)`` rows; only ``kinds``, if given.

    The gates decide which kinds a post has: its normalised words, those again in
    harmful context, its raw words in context and in strict context, its neighbouring
    pairs, and its words with first letters swapped.
    """
    words = L.with_norm_words(L.with_raw_words(posts.select(key, "text"), lex), lex)
    words = L.with_norm_score(words, lex)
    raw, norm, score = F.col("raw_words"), F.col("norm_words"), F.col("raw_score")
    two_norm = T.has_two_long_words(norm)
    pairs = T.bigrams(raw)
    wide = F.filter(pairs, lambda p: (F.length(p["a"]) > 2) & (F.length(p["b"]) > 2))
    swapped = F.flatten(F.transform(wide, lambda p: F.array(*T.swap_initials(p["a"], p["b"]))))
    in_context = D.context_gate(score)
    parts = {
        "norm": F.when(two_norm, T.long_words(norm)),
        "norm_context": F.when(two_norm & D.context_gate(F.col("norm_score")), T.long_words(norm)),
        "raw": F.when(D.homophone_gate(raw, score), T.long_words(raw)),
        "raw_strict": F.when(D.homophone_gate(raw, score, MIN_CONTEXT + 1), T.long_words(raw)),
        "pair": F.when(in_context, F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"]))),
        "swap": F.when(in_context, swapped),
    }

    def tagged(kind: str, values: Column) -> Column:
        made = F.transform(
            F.array_distinct(values), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("key"))
        )
        return F.coalesce(made, F.array().cast("array<struct<kind: string, key: string>>"))

    everything = F.concat(*(tagged(kind, values) for kind, values in parts.items() if kinds is None or kind in kinds))
    return _exploded(words, everything, key).select(key, "value.kind", "value.key")


def label_evasion_join(
    posts: DataFrame,
    harmful: DataFrame,
    related: DataFrame,
    swaps: DataFrame,
    lex: Lexicons,
    phonetic: bool = True,
    key: str = "post_id",
    sound=skeleton_key,
) -> DataFrame:
    """D12 for lexicons of any size: ``(post_id, labels)`` of every post.

    ``harmful`` is ``(word)``, ``related`` is ``(token, related)`` (C4) and ``swaps`` is
    ``(s1, s2, o1, o2)`` (C5); ``lex`` gives substitutions and context weights. Harmful
    words under the least length are left out, as ``Lexicons`` has none. ``sound`` is a
    phonetic key, as a function or as a table (see ``phonetic_words``).

    The first step, run when called, matches the distinct gated vocabulary and settles the
    targets: what a post must hold to earn a label. The second is one narrow pass.
    """
    bad = harmful.select("word").filter(F.length("word") >= MIN_WORD_LENGTH).distinct()
    keys = match_keys(posts, lex, key)
    near = match_keys(posts, lex, key, ("norm_context", "raw_strict")).groupBy(F.col("key").alias("word")).agg(
        F.bool_or(F.col("kind") == "norm_context").alias("norm_context"),
        F.bool_or(F.col("kind") == "raw_strict").alias("raw_strict"),
    )
    vocabulary = settled(near, "vocabulary")

    def words_of(kind: str) -> DataFrame:
        return vocabulary.filter(kind).select("word")

    def target(frame: DataFrame, column: str, kind: str, label: str) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("kind"), F.col(column).alias("key"), F.lit(label).alias("label")
        )

    listed = related.select("token", F.col("related").alias("word")).join(bad, "word", "left_semi")
    phrases = swaps.select(
        F.concat_ws(" ", "s1", "s2").alias("pair"), F.explode(F.array("o1", "o2")).alias("word")
    ).join(bad, "word", "left_semi")
    targets = [
        target(bad, "word", "norm", CHARSUB_LABEL),
        target(fuzzy_words(words_of("norm_context"), bad), "word", "norm_context", CHARSUB_LABEL),
        target(listed, "token", "raw", HOMOPHONE_LABEL),
        target(phrases, "pair", "pair", SPOONERISM_LABEL),
        target(bad, "word", "swap", SPOONERISM_LABEL),
    ]
    if phonetic:
        sounds = phonetic_words(words_of("raw_strict"), bad, sound)
        targets.append(target(sounds, "word", "raw_strict", HOMOPHONE_LABEL))
    wanted = settled(reduce(DataFrame.union, targets).distinct(), "targets")
    found = keys.join(wanted, ["kind", "key"]).groupBy(key).agg(*(
        F.bool_or(F.col("label") == label).alias(name)
        for name, label in zip(("charsub", "homophone", "spoonerism"), SPECIFIC_LABELS)
    ))
    flags = [F.coalesce(name, F.lit(False)) for name in ("charsub", "homophone", "spoonerism")]
    return posts.select(key).join(found, key, "left").select(
        key, L.evasion_labels(*flags).alias("labels")
    )
