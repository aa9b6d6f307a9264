"""Lexicons: the fixed word lists, and the bounded form the detectors inline.

``Lexicons`` holds driver-side tuples. Everything in it is embedded in the query plan as
literals, which suits curated lists. A long list stays a DataFrame and goes through
``operators.lexicon_join``, which gives the same rows at any size; files are brought to
the driver only up to ``INLINE_LIMIT`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

INLINE_LIMIT = 10_000

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published lists for results to be right.
# ---------------------------------------------------------------------------

GENERAL_LABEL = "linguistic-evasion"
CHARSUB_LABEL = "character-substitution"
HOMOPHONE_LABEL = "homophone"
SPOONERISM_LABEL = "spoonerism"
SPECIFIC_LABELS = (CHARSUB_LABEL, HOMOPHONE_LABEL, SPOONERISM_LABEL)
TS_LABEL = "t-and-s"
IMAGE_LABEL = "dog"

MIN_WORD_LENGTH = 4
HIGH_CONFIDENCE_LENGTH = 6
MIN_CONTEXT = 2
CHARSUB_THRESHOLD = 0.85
PHONETIC_THRESHOLD = 0.8
SHORT_WORD_LENGTH = 6
SHORT_WORD_PENALTY = 0.05
IMAGE_THRESHOLD = 0.3
SEARCH_LIMIT = 25

HARMFUL_LINES = (
    "ass", "bitch", "crap", "damn", "dick", "fuck", "hell", "idiot", "jerk",
    "moron", "shit", "slut", "whore", "kill", "die", "suicide", "hate", "dumb",
    "stupid", "retard", "trash", "ugly", "fat", "bomb", "terrorist", "freak",
    "gay", "queer", "trans", "nazi", "racist", "sexist", "loser ",
)

# Ordered; the key "9" is listed twice on purpose (the later value wins).
SUBSTITUTION_ENTRIES = (
    ("@", "a"), ("4", "a"), ("8", "b"), ("(", "c"), ("3", "e"), ("€", "e"),
    ("6", "g"), ("9", "g"), ("#", "h"), ("1", "i"), ("!", "i"), ("|", "i"),
    ("k", "c"), ("0", "o"), ("()", "o"), ("p", "p"), ("9", "q"), ("5", "s"),
    ("$", "s"), ("7", "t"), ("+", "t"), ("v", "v"), ("vv", "w"), ("×", "x"),
    ("%", "x"), ("2", "z"),
)

HOMOPHONE_ENTRIES = (
    ("die", ("dye", "di")),
    ("kill", ("kil", "keel", "keel")),
    ("hate", ("h8", "hayt", "hait")),
    ("for", ("4", "fore", "four")),
    ("to", ("2", "too", "two")),
    ("you", ("u", "yew", "ewe")),
    ("your", ("ur", "you're", "yore")),
    ("bitch", ("b!tch", "beach", "beech")),
    ("shit", ("sh!t", "sheet", "cheat")),
    ("fuck", ("fuk", "phuck", "fack")),
    ("ass", ("a$$", "as", "@ss")),
    ("dick", ("d!ck", "dik", "dyk")),
    ("suicide", ("sewer side", "sue a side")),
    ("gay", ("ghey", "gey", "g@y")),
    ("trans", ("tr@ns", "tranz", "trance")),
    ("racist", ("r@cist", "race ist", "ray cyst")),
    ("here", ("hear", "heer")),
    ("know", ("no", "noe")),
    ("right", ("write", "rite")),
)

# (original pair, swapped pair)
SPOONERISM_ENTRIES = (
    (("kill", "you"), ("yill", "kou")),
    (("fuck", "you"), ("yuck", "fou")),
    (("kill", "them"), ("till", "khem")),
    (("kill", "yourself"), ("yill", "kourself")),
    (("fuck", "off"), ("ock", "fuff")),
    (("shit", "head"), ("hit", "shead")),
    (("dumb", "ass"), ("aumb", "dass")),
    (("suck", "it"), ("ick", "sut")),
    (("hate", "you"), ("yate", "hou")),
    (("die", "now"), ("nie", "dow")),
)

CONTEXT_WEIGHTS = {
    "hate": 2, "stupid": 1, "ugly": 1, "bad": 1, "worst": 1, "die": 3,
    "death": 3, "kill": 3, "dead": 2, "fuck": 2, "shit": 1, "damn": 1,
    "hell": 1, "idiot": 2, "dumb": 1, "worthless": 2, "trash": 1,
    "horrible": 1, "attack": 2, "violent": 2, "destroy": 2, "hurt": 2,
    "harm": 2,
}

# First line of each list is its header; see ``header_as_entry``.
TS_WORD_LINES = (
    "Word", "Action notice", "Adversarial behavior", "Allowlisting", "Banning",
    "Blocking", "Community standards", "Community moderation", "Content",
    "Demonetization", "Downranking", "Downvoting", "Flagging", "Geo-Blocking",
    "Greylisting", "Hash-matching", "Legal information request",
    "Misinformation", "Phishing", "Platform", "Safety by design", "Spam",
    "Terms of service", "Trolling", "User data", "User-generated content",
    "Virality",
)

TS_DOMAIN_LINES = (
    "Domain", "www.tspa.org", "www.trustcon.net",
    "conferences.law.stanford.edu/tsrc",
    "github.com/cornelltech/cs5342-spring2025", "www.trustsafety.net",
    "trustandsafetyfoundation.org/", "everythinginmoderation.co",
    "roost.tools", "integrityinstitute.org",
)

NEWS_ENTRIES = (
    ("cnn.com", "cnn"), ("bbc.com", "bbc"), ("nytimes.com", "nyt"),
    ("washingtonpost.com", "wapo"), ("foxnews.com", "fox"),
    ("reuters.com", "reuters"), ("apnews.com", "ap"),
)

POSITIVE_TERMS = {
    CHARSUB_LABEL: (
        "f@ck", "sh1t", "b!tch", "k1ll", "d!e", "h@te", "r3t@rd", "1d1ot",
        "@$$", "d1ck", "wh0re", "m0r0n", "r@c1st", "n@z1", "$tupid", "tr@$h",
        "fr3@k", "$lu+", "+err0r1st",
    ),
    HOMOPHONE_LABEL: (
        "dye now", "kil yourself", "keel him", "h8 speech", "h8 you",
        "hayt crime", "4 you to die", "ur ugly", "ur stupid", "beach please",
        "sheet happens", "phuck that", "as hole", "sewer side thoughts",
        "commit sewer side", "ghey people", "gey marriage", "tranz people",
        "ray cyst comment", "race ist ideology", "yew deserve to die",
        "ewe should leave",
    ),
    SPOONERISM_LABEL: (
        "yill kou", "yuck fou", "buck you", "till khem", "yill kourself",
        "ock fuff", "hit shead", "aumb dass", "ick sut", "yate hou", "nie dow",
        "fit the shan", "wit the fhat", "shaming neep", "ducking sick",
        "rucking fetarded", "bunning cumhag", "dumb fick", "tumb dass",
        "hure pussy",
    ),
}

NEUTRAL_TERMS = (
    "good morning", "happy birthday", "beautiful day", "thanks for sharing",
    "just posted", "great photo", "interesting article", "weather today",
    "weekend plans", "new recipe", "love this song", "favorite book",
    "tech news", "just learned", "thinking about", "excited to share",
)

NEUTRAL_TOPICS = (
    "photography", "cooking", "hiking", "gardening", "reading", "travel",
    "music", "art", "technology", "science", "space", "history", "nature",
    "sports",
)

# ---------------------------------------------------------------------------


def clean_lines(lines, min_length: int = 1) -> tuple[str, ...]:
    """Strip, lower-case, drop short entries, dedupe keeping order."""
    seen = dict.fromkeys(line.strip().lower() for line in lines)
    return tuple(w for w in seen if len(w) >= min_length)


def last_wins(entries) -> tuple:
    """Duplicate keys keep their first position and their last value."""
    return tuple(dict(entries).items())


def two_way(entries) -> dict[str, frozenset[str]]:
    """Word to related words, in both directions.

    A later key replaces what earlier entries stored for it as a variant.
    """
    related: dict[str, set[str]] = {}
    for word, variants in entries:
        related[word] = set(variants)
        for variant in variants:
            related.setdefault(variant, set()).add(word)
    return {word: frozenset(other) for word, other in related.items()}


@dataclass(frozen=True)
class Lexicons:
    """Everything the labelers match against, ready to be inlined."""

    harmful: tuple[str, ...] = clean_lines(HARMFUL_LINES, MIN_WORD_LENGTH)
    substitutions: tuple[tuple[str, str], ...] = last_wins(SUBSTITUTION_ENTRIES)
    homophones: tuple[tuple[str, tuple[str, ...]], ...] = last_wins(HOMOPHONE_ENTRIES)
    spoonerisms: tuple[tuple[tuple[str, str], tuple[str, str]], ...] = SPOONERISM_ENTRIES
    context: dict[str, int] = field(default_factory=lambda: dict(CONTEXT_WEIGHTS))
    ts_words: tuple[str, ...] = clean_lines(TS_WORD_LINES)
    ts_domains: tuple[str, ...] = clean_lines(TS_DOMAIN_LINES)
    news: tuple[tuple[str, str], ...] = last_wins(NEWS_ENTRIES)

    def __post_init__(self):
        if any(len(w) < MIN_WORD_LENGTH for w in self.harmful):
            raise ValueError(f"harmful words need at least {MIN_WORD_LENGTH} characters")

    def high_confidence(self) -> tuple[str, ...]:
        return tuple(w for w in self.harmful if len(w) >= HIGH_CONFIDENCE_LENGTH)

    def firing_homophones(self) -> tuple[str, ...]:
        """Tokens that a dictionary lookup can flag."""
        harmful = set(self.harmful)
        return tuple(w for w, other in two_way(self.homophones).items() if other & harmful)

    def firing_spoonerisms(self) -> tuple[tuple[str, str], ...]:
        """Swapped pairs whose (last listed) original holds a harmful word."""
        harmful = set(self.harmful)
        originals = {swapped: original for original, swapped in self.spoonerisms}
        return tuple(s for s, original in originals.items() if harmful & set(original))


def threshold_for(word: str, base: float) -> float:
    """Similarity threshold; stricter when the lexicon word is short."""
    return base + SHORT_WORD_PENALTY if len(word) < SHORT_WORD_LENGTH else base


def max_edits(word: str, other_length: int) -> int:
    """Most edits that keep ``1 - edits/longest`` at or over the word's threshold.

    Computed with the same floating-point arithmetic as the comparison itself, so
    boundary lengths round the same way.
    """
    longest = max(len(word), other_length)
    limit = threshold_for(word, CHARSUB_THRESHOLD)
    edits = 0
    while edits < longest and 1.0 - (edits + 1) / longest >= limit:
        edits += 1
    return edits
