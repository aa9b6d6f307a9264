"""Plain-Python statement of the labeling rules, used as brute force in tests."""

from __future__ import annotations

import re

from slyglot.lexicons import Lexicons


def tokens(text):
    return re.findall(r"\w+", text)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similarity(a, b):
    if not a or not b or abs(len(a) - len(b)) > 2:
        return 0.0
    return 1.0 - edits(a, b) / max(len(a), len(b))


def naive_normalize(text, entries):
    text = text.lower()
    for old, new in entries:
        text = text.replace(old, new)
    return text


def score(words, lex):
    return sum(lex.context.get(w, 0) for w in words)


def limit(word, base):
    return base + 0.05 if len(word) < 6 else base


def has_charsub(text, lex):
    everything = tokens(naive_normalize(text, lex.substitutions))
    words = [w for w in everything if len(w) >= 4]
    if len(words) < 2:
        return False
    if set(words) & set(lex.harmful):
        return True
    near = any(
        abs(len(w) - len(h)) <= 1 and similarity(w, h) >= limit(h, 0.85)
        for w in words for h in lex.harmful
    )
    return near and score(everything, lex) >= 2


def skeletons(word):
    by_sound = word.translate(str.maketrans("cqxzv", "kkssf"))
    return re.sub("[aeiouy]", "", word), re.sub("[aeiouhy]", "", by_sound)


def sounds_like(word, harmful):
    best = 0.0
    for p in filter(None, skeletons(word)):
        for q in filter(None, skeletons(harmful)):
            best = max(best, sum(a == b for a, b in zip(p, q)) / max(len(p), len(q)))
    return best >= limit(harmful, 0.8)


def has_phonetic(text, lex):
    everything = tokens(text.lower())
    words = [w for w in everything if len(w) >= 4]
    if len(words) < 2 or score(everything, lex) < 3:
        return False
    return any(w != h and sounds_like(w, h) for w in words for h in lex.harmful)


def has_listed_homophone(text, lex):
    everything = tokens(text.lower())
    words = [w for w in everything if len(w) >= 4]
    if len(words) < 2 or score(everything, lex) < 2:
        return False
    listed = {}
    for word, variants in lex.homophones:
        listed.setdefault(word, set()).update(variants)
        for v in variants:
            listed.setdefault(v, set()).add(word)
    return any(listed.get(w, set()) & set(lex.harmful) for w in words)


def has_spoonerism(text, lex):
    words = tokens(text.lower())
    if len(words) < 2 or score(words, lex) < 2:
        return False
    listed = {swapped: original for original, swapped in lex.spoonerisms}
    for a, b in zip(words, words[1:]):
        if set(listed.get((a, b), ())) & set(lex.harmful):
            return True
        if len(a) > 2 and len(b) > 2 and {b[0] + a[1:], a[0] + b[1:]} & set(lex.harmful):
            return True
    return False


def labels(text, lex=Lexicons(), phonetic=True):
    if text is None:
        return []
    out = []
    if has_charsub(text, lex):
        out.append("character-substitution")
    if has_listed_homophone(text, lex) or (phonetic and has_phonetic(text, lex)):
        out.append("homophone")
    if has_spoonerism(text, lex):
        out.append("spoonerism")
    return out + ["linguistic-evasion"] * bool(out)
