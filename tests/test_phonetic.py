"""Phonetic codes of well-known words, and the vocabulary job."""

import pytest

from slyglot.functions.phonetic import phonetic_codes, phonetic_key
from slyglot.operators import lexicon_prep as prep

CODES = {
    "kill": "KL", "hate": "HT", "michael": "MKL", "thomas": "TMS", "smith": "SM0",
    "schmidt": "XMT", "knight": "NT", "write": "RT", "philip": "FLP", "laugh": "LF",
    "architect": "ARKTKT", "caesar": "SSR", "chianti": "KNT", "chorus": "KRS",
    "bacher": "PKR", "dumb": "TM", "edge": "AJ", "nation": "NXN", "school": "SKL",
    "sugar": "XKR", "xavier": "SF", "accident": "AKSTNT", "tough": "TF", "island": "ALNT",
    "bitch": "PX", "sheet": "XT", "phuck": "FK", "beech": "PX", "gnome": "NM", "cough": "KF",
    "ghost": "KST", "thumb": "0M", "zhao": "J", "hugh": "H", "cagney": "KKN", "mac": "MK",
}


@pytest.mark.parametrize("word,code", CODES.items())
def test_known_primary_code(word, code):
    assert phonetic_codes(word)[0] == code


def test_secondary_codes():
    assert phonetic_codes("smith") == ("SM0", "XMT")
    assert phonetic_codes("jerk") == ("JRK", "ARK")
    assert phonetic_codes("kill") == ("KL", "")
    assert phonetic_codes("señor") == phonetic_codes("senor")
    assert phonetic_codes("123") == ("", "")


def test_vocabulary_job_and_index(spark):
    words = spark.createDataFrame([(w,) for w in ("kill", "kyll", "kill", "smith", "123", None)], "word string")
    got = {r.word: (r.primary, r.secondary) for r in prep.phonetic_vocabulary(words, phonetic_key).collect()}
    assert got == {"kill": ("KL", ""), "kyll": ("KL", ""), "smith": ("SM0", "XMT"), "123": ("", ""), None: (None, None)}
    index = {(r.code, r.word) for r in prep.phonetic_index(words.dropna(), phonetic_key).collect()}
    assert index == {("KL", "kill"), ("KL", "kyll"), ("SM0", "smith"), ("XMT", "smith")}
