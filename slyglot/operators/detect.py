"""Detectors D1-D11 as column expressions.

Each takes word arrays that the caller computed once per post (see
``operators.labelers.with_raw_words``) and stays inside one stage: no shuffle, no
per-row Python. The lexicons are bounded by ``Lexicons`` and become
literals (hash-set lookups) in the plan.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.functions.phonetic import codes_of
from slyglot.lexicons import MIN_CONTEXT, PHONETIC_THRESHOLD, Lexicons, max_edits, threshold_for


def context_score(tokens: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of all words, counted with repetition."""
    classes = defaultdict(list)
    for word, weight in weights.items():
        classes[weight].append(word)

    def weight_of(word: Column) -> Column:
        out = F.lit(0)
        for weight, members in sorted(classes.items()):
            out = F.when(word.isin(members), weight).otherwise(out)
        # one hash lookup settles the words that carry no weight
        return F.when(word.isin(list(weights)), out).otherwise(F.lit(0))

    score = F.aggregate(tokens, F.lit(0), lambda total, w: total + weight_of(w))
    return F.coalesce(score, F.lit(0))


def context_gate(score: Column, minimum: int = MIN_CONTEXT) -> Column:
    """Enough harmful context."""
    return score >= minimum


def is_harmful(word: Column, lex: Lexicons) -> Column:
    return word.isin(list(lex.harmful))


def charsub_exact(norm_words: Column, lex: Lexicons) -> Column:
    """D3: a normalised word is a harmful word."""
    hit = F.exists(norm_words, lambda w: is_harmful(w, lex))
    return F.coalesce(hit & T.has_two_long_words(norm_words), F.lit(False))


def fuzzy_candidates(lex: Lexicons) -> dict[int, list[tuple[str, int]]]:
    """Word length -> harmful words (and edits allowed) that a non-equal word can reach."""
    by_length = defaultdict(list)
    for harmful in lex.harmful:
        for length in (len(harmful) - 1, len(harmful), len(harmful) + 1):
            edits = max_edits(harmful, length)
            if edits > 0 and length >= T.MIN_WORD_LENGTH:
                by_length[length].append((harmful, edits))
    return dict(by_length)


def _shares_an_end(word: Column, near: list[tuple[str, int]]) -> Column:
    """Necessary for one edit: the words start alike or end alike, up to half their length."""
    if any(edits > 1 for _, edits in near):
        return F.lit(True)
    size = min(len(h) for h, _ in near) // 2
    starts, ends = sorted({h[:size] for h, _ in near}), sorted({h[-size:] for h, _ in near})
    return F.left(word, F.lit(size)).isin(starts) | F.right(word, F.lit(size)).isin(ends)


def is_near_harmful(word: Column, lex: Lexicons) -> Column:
    """A word within its allowed edits of a harmful word, but not equal to it."""
    by_length = fuzzy_candidates(lex)
    if not by_length:
        return F.lit(False)
    within_edits = T.any_of(
        (F.length(word) == length)
        & T.any_of(F.levenshtein(word, F.lit(h), edits) >= 1 for h, edits in near)
        for length, near in sorted(by_length.items())
    )
    in_reach = F.length(word).between(min(by_length), max(by_length))
    everyone = [pair for near in by_length.values() for pair in near]
    return in_reach & _shares_an_end(word, everyone) & within_edits


def charsub_fuzzy(norm_words: Column, norm_score: Column, lex: Lexicons) -> Column:
    """A normalised word is close to a harmful word, in harmful context."""
    hit = F.exists(norm_words, lambda w: is_near_harmful(w, lex))
    gate = context_gate(norm_score) & T.has_two_long_words(norm_words)
    return F.coalesce(hit & gate, F.lit(False))


def charsub(norm_words: Column, lex: Lexicons) -> Column:
    """Exact match, or close match in context.

    One pass over the words settles most posts. Only a post with a suspicious word
    goes on to ask whether it is an exact one and how harmful the context is.
    """
    suspicious = F.exists(norm_words, lambda w: is_harmful(w, lex) | is_near_harmful(w, lex))
    exact = F.exists(norm_words, lambda w: is_harmful(w, lex))
    in_context = context_gate(context_score(norm_words, lex.context))
    hit = suspicious & (exact | in_context) & T.has_two_long_words(norm_words)
    return F.coalesce(hit, F.lit(False))


def homophone_gate(raw_words: Column, score: Column, minimum: int = MIN_CONTEXT) -> Column:
    return context_gate(score, minimum) & T.has_two_long_words(raw_words)


def homophone_dictionary(raw_words: Column, score: Column, lex: Lexicons) -> Column:
    """A long word is listed as a homophone of a harmful word."""
    fires = [w for w in lex.firing_homophones() if len(w) >= T.MIN_WORD_LENGTH]
    hit = F.exists(raw_words, lambda w: w.isin(fires)) if fires else F.lit(False)
    return F.coalesce(context_gate(score) & hit & T.has_two_long_words(raw_words), F.lit(False))


def phonetic_candidates(raw_words: Column, score: Column) -> Column:
    """D7 input: the distinct long words of posts that pass the stricter gate, else NULL."""
    gate = homophone_gate(raw_words, score, MIN_CONTEXT + 1)
    return F.when(gate, F.array_distinct(T.long_words(raw_words)))


def codes_agree(left: Column, right: Column, needed: Column) -> Column:
    """Two non-empty codes agree in the needed share of positions.

    Equality and lengths settle nearly all pairs, so few are compared by position.
    """
    a, b = F.length(left), F.length(right)
    return (
        F.when(left == right, F.lit(True))
        .when(F.least(a, b) / F.greatest(a, b) < needed, F.lit(False))
        .otherwise(T.code_similarity(left, right) >= needed)
    )


def sounds_harmful(candidates: Column, lex: Lexicons, key) -> Column:
    """Some word sounds like a harmful word other than itself; False for NULL.

    The lexicon's codes are constants, folded when the plan is made. Codes of fewer than
    ten characters agree well enough only if they are equal or differ in one position;
    then one of their first two pairs of characters is the same. That is looked up before
    the codes are compared with each entry.
    """
    if not lex.harmful:
        return F.lit(False)
    codes = [(h, key(F.lit(h))[part]) for h in lex.harmful for part in ("primary", "secondary")]
    known = F.array(*(
        F.struct(F.lit(h).alias("word"), code.alias("code"), F.lit(threshold_for(h, PHONETIC_THRESHOLD)).alias("needed"))
        for h, code in codes
    ))
    equal = F.array(*(code for _, code in codes))
    pairs = [F.array(*(F.substring(code, at, 2) for _, code in codes)) for at in (1, 3)]

    def may_agree(code: Column) -> Column:
        shared = F.array_contains(pairs[0], F.substring(code, 1, 2)) | F.array_contains(pairs[1], F.substring(code, 3, 2))
        return F.array_contains(equal, code) | (F.length(code) >= 9) | ((F.length(code) >= 4) & shared)

    def heard(word: Column) -> Column:
        near = lambda code: may_agree(code) & F.exists(
            known, lambda k: (k["word"] != word) & codes_agree(code, k["code"], k["needed"])
        )
        return F.exists(codes_of(key(word)), near)

    return F.coalesce(F.exists(candidates, heard), F.lit(False))


def homophone(raw_words: Column, score: Column, lex: Lexicons, key) -> Column:
    """The dictionary, then the phonetic match for posts it does not flag."""
    candidates = phonetic_candidates(raw_words, score)
    return F.when(homophone_dictionary(raw_words, score, lex), True).otherwise(
        sounds_harmful(candidates, lex, key)
    )


def is_listed_spoonerism(a: Column, b: Column, lex: Lexicons) -> Column:
    pairs = lex.firing_spoonerisms()
    firsts = sorted({p[0] for p in pairs})
    joined = [f"{p[0]} {p[1]}" for p in pairs]
    if not pairs:
        return F.lit(False)
    return a.isin(firsts) & F.concat_ws(" ", a, b).isin(joined)


def is_swapped_harmful(a: Column, b: Column, lex: Lexicons) -> Column:
    tails = sorted({w[1:] for w in lex.harmful})
    swapped_a, swapped_b = T.swap_initials(a, b)
    harmful = list(lex.harmful)
    rest = lambda w: F.substring(w, 2, 2_147_483_647)
    return (
        (F.length(a) > 2)
        & (F.length(b) > 2)
        & (
            (rest(a).isin(tails) & swapped_a.isin(harmful))
            | (rest(b).isin(tails) & swapped_b.isin(harmful))
        )
    )


def spoonerism_dictionary(raw_words: Column, score: Column, lex: Lexicons) -> Column:
    """Neighbours are a listed swap of a harmful phrase."""
    hit = T.any_adjacent(raw_words, lambda a, b: is_listed_spoonerism(a, b, lex))
    return F.coalesce(context_gate(score) & hit, F.lit(False))


def spoonerism_swap(raw_words: Column, score: Column, lex: Lexicons) -> Column:
    """Swapping the first letters of neighbours gives a harmful word."""
    hit = T.any_adjacent(raw_words, lambda a, b: is_swapped_harmful(a, b, lex))
    return F.coalesce(context_gate(score) & hit, F.lit(False))


def spoonerism(raw_words: Column, score: Column, lex: Lexicons) -> Column:
    """Listed or computed swap, in harmful context."""
    hit = T.any_adjacent(
        raw_words,
        lambda a, b: is_listed_spoonerism(a, b, lex) | is_swapped_harmful(a, b, lex),
    )
    return F.coalesce(context_gate(score) & hit, F.lit(False))


def contains_any(lowered: Column, patterns) -> Column:
    """Lower-cased text contains some pattern as a substring."""
    return F.coalesce(T.any_of(F.contains(lowered, F.lit(p)) for p in patterns), F.lit(False))


def pair_labels(lowered: Column, entries) -> Column:
    """Labels whose pattern occurs in the text, in list order, without repeats."""
    hits = [F.when(F.contains(lowered, F.lit(p)), F.lit(label)) for p, label in entries]
    return F.array_distinct(F.array_compact(F.array(*hits)))
