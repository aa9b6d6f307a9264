"""Phonetic keys: a column function from a word to two codes.

Matching takes the key as an argument. ``skeleton_key`` is made of built-in expressions
and runs inside the scan of the posts. ``phonetic_key`` (Double Metaphone, Philips 2000)
is an optional key outside the hot path: apply it to a distinct vocabulary and hand the
keyed table to ``lexicon_join.phonetic_words``.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The rules, by the letter they start at. ``v`` stands for a vowel.
# A row is (spelling with context, primary code, secondary code, only-if flag); a
# missing secondary equals the primary. The first matching row applies and the
# letters it matches are consumed. Flags: "plain" = the word does not look Slavic or
# Germanic, "slavic" = it does, "sch" = it starts with SCH.
RULES = {
    "B": (
        ("BB?", "P"),
    ),
    "C": (
        ("(?<=[^AEIOUY]A)CH(?![IE])", "K"),
        ("(?<=[BM]A)CH(?=ER)", "K"),
        ("^CA(?=ESAR)", "S"),
        ("CH(?=IA)", "K"),
        ("(?!^)CH(?=AE)", "K", "X"),
        ("^CH(?=ARAC|ARIS|OR(?!E)|YM|IA|EM)", "K"),
        ("CH", "K", None, "sch"),
        ("(?<=OR)CH(?=ES|ID)", "K"),
        ("(?<=AR)CH(?=IT)", "K"),
        ("CH(?=[TS])", "K"),
        ("(?:^|(?<=[AOUE]))CH(?=[LRNMBHFVW])", "K"),
        ("^CH", "X"),
        ("(?<=^M)CH", "K"),
        ("CH", "X", "K"),
        ("(?<!WI)CZ", "S", "X"),
        ("CCI(?=A)", "X"),
        ("(?<=^A)CC(?!HU)[IEH]", "KS"),
        ("(?<=U)CCE(?=[ES])", "KS"),
        ("(?<!^M)CC(?!HU)[IEH]", "X"),
        ("(?<!^M)CC", "K"),
        ("C[KGQ]", "K"),
        ("CI(?=[OEA])", "S", "X"),
        ("C[IEY]", "S"),
        ("C(?!C[EI])[CKQ]?", "K"),
    ),
    "D": (
        ("DG[IEY]", "J"),
        ("DG", "TK"),
        ("D[TD]?", "T"),
    ),
    "F": (
        ("FF?", "F"),
    ),
    "G": (
        ("^G(?=N)", ""),
        ("(?<=[^AEIOUY])GH", "K"),
        ("^GH(?=I)", "J"),
        ("^GH", "K"),
        ("(?<=[BHD].)GH", ""),
        ("(?<=[BHD]..)GH", ""),
        ("(?<=[BH]...)GH", ""),
        ("(?<=[CGLRT].U)GH", "F"),
        ("(?<!I)GH", "K"),
        ("GH", ""),
        ("(?<=^v)GN", "KN", "N", "plain"),
        ("GN(?!EY)", "N", "KN", "plain"),
        ("GN", "KN"),
        ("GL(?=I)", "KL", "L", "plain"),
        ("^G(?=Y|E[SPBLYIR]|I[BLNE]).", "K", "J"),
        ("(?<![EI])(?<!^[DRM]AN)G(?=ER).", "K", "J"),
        ("(?<![EIRO])G(?=Y).", "K", "J"),
        ("G[EIY]", "K", None, "sch"),
        ("G(?=ET).", "K"),
        ("G[EIY]", "J", "K"),
        ("(?<=[AO])GG(?=I)", "J", "K"),
        ("GG?", "K"),
    ),
    "H": (
        ("(?:^|(?<=v))H(?=v)", "H"),
        ("H", ""),
    ),
    "J": (
        ("^JOSE$", "HS"),
        ("J(?=OSE)", "J", "H"),
        ("^JJ?", "J", "A"),
        ("(?<=v)J(?=[AO])", "J", "H", "plain"),
        ("J$", "J", ""),
        ("(?<![SKL])J(?![LTKSNMBZ])J?", "J"),
        ("JJ?", ""),
    ),
    "K": (
        ("^K(?=N)", ""),
        ("KK?", "K"),
    ),
    "L": (
        ("(?<=I)LL(?=[OA]$)", "L", ""),
        ("(?<=A)LL(?=E(?:$|.*[AO]S?$))", "L", ""),
        ("LL?", "L"),
    ),
    "M": (
        ("(?<=U)MB(?=$|ER)", "M"),
        ("MM?", "M"),
    ),
    "N": (
        ("NN?", "N"),
    ),
    "P": (
        ("^P(?=[NS])", ""),
        ("PH", "F"),
        ("P[PB]?", "P"),
    ),
    "Q": (
        ("QQ?", "K"),
    ),
    "R": (
        ("(?<!M[EA]IE)(?<=IE)R$", "", "R", "plain"),
        ("RR?", "R"),
    ),
    "S": (
        ("(?<=[IY])S(?=L)", ""),
        ("^S(?=UGAR)", "X", "S"),
        ("SH(?=EIM|OEK|OLM|OLZ)", "S"),
        ("SH", "X"),
        ("SI[OA]", "S", "X", "plain"),
        ("SI[OA]", "S"),
        ("SZ", "S", "X"),
        ("^S(?=[MNLW])", "S", "X"),
        ("SCH(?=E[RN])", "X", "SK"),
        ("SCH(?=OO|UY|E[DM])", "SK"),
        ("^SCH(?![AEIOUYW])", "X", "S"),
        ("SCH", "X"),
        ("SC[IEY]", "S"),
        ("SC.?", "SK"),
        ("(?<=[AO]I)S$", "", "S"),
        ("S[SZ]?", "S"),
    ),
    "T": (
        ("TIO(?=N)", "X"),
        ("TIA", "X"),
        ("TCH", "X"),
        ("TH(?=[OA]M)", "T"),
        ("TH", "T", None, "sch"),
        ("TH", "0", "T"),
        ("TT(?=H)", "0", "T"),
        ("T[TD]?", "T"),
    ),
    "V": (
        ("VV?", "F"),
    ),
    "W": (
        ("WR", "R"),
        ("^W(?=R)", ""),
        ("^W(?=v)", "A", "F"),
        ("^W(?=H)", "A"),
        ("(?<=v)W$", "", "F"),
        ("(?<=[EO])W(?=SK[IY])", "", "F"),
        ("W", "", "F", "sch"),
        ("WI[CT]Z", "TS", "FX"),
        ("W", ""),
    ),
    "X": (
        ("^X", "S"),
        ("(?<=[IE]AU)X$", ""),
        ("(?<=[AO]U)X$", ""),
        ("X[CX]?", "KS"),
    ),
    "Z": (
        ("ZH", "J"),
        ("Z(?=[OIA])", "S", "TS"),
        ("(?!^)(?<!T)ZZ?", "S", "TS", "slavic"),
        ("ZZ?", "S"),
    ),
}

VOWELS = "AEIOUY"


@lru_cache
def _spellings(flags: frozenset[str]) -> dict[str, tuple[re.Pattern, list[tuple[str, str]]]]:
    """Per letter: one pattern with a group for each row in force, and the rows' codes."""
    table = {}
    for letter, rows in {**RULES, **{v: (("^v", "A"),) for v in VOWELS}}.items():
        used = [row for row in rows if len(row) < 4 or row[3] in flags]
        pattern = "|".join(f"({row[0]})" for row in used).replace("v", f"[{VOWELS}]")
        codes = [(row[1], row[1] if len(row) < 3 or row[2] is None else row[2]) for row in used]
        table[letter] = re.compile(pattern), codes
    return table


def _letters(word: str) -> str:
    """Upper case without accents."""
    if not word.isascii():
        decomposed = unicodedata.normalize("NFD", word)
        word = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
    return word.upper()


@lru_cache(maxsize=200_000)
def phonetic_codes(word: str) -> tuple[str, str]:
    """Primary and secondary code of one word; the secondary is "" if equal."""
    letters = _letters(word)
    slavic = any(sign in letters for sign in ("W", "K", "CZ", "WITZ"))
    starts_sch = letters.startswith("SCH")
    table = _spellings(frozenset(["slavic" if slavic else "plain", *["sch"] * starts_sch]))
    first, second, at = "", "", 0
    while at < len(letters):
        pattern, codes = table.get(letters[at], (None, ()))
        match = pattern.match(letters, at) if pattern else None
        if match:
            primary, secondary = codes[match.lastindex - 1]
            first, second, at = first + primary, second + secondary, match.end()
        else:
            at += 1
    return first, "" if second == first else second


KEY_TYPE = StructType(
    [StructField("primary", StringType()), StructField("secondary", StringType())]
)


@F.arrow_udf(KEY_TYPE)
def phonetic_key(word: pa.Array) -> pa.Array:
    """Both codes of a word column; apply it to a distinct vocabulary."""
    codes = [(None, None) if w is None else phonetic_codes(w) for w in word.to_pylist()]
    return pa.StructArray.from_arrays(
        [pa.array([c[i] for c in codes], pa.string()) for i in (0, 1)], ["primary", "secondary"]
    )


def skeleton_key(word: Column) -> Column:
    """Two codes from built-in expressions: the consonants, and the consonants by sound."""
    by_sound = F.translate(word, "cqxzv", "kkssf")
    return F.struct(
        F.regexp_replace(word, "[aeiouy]", "").alias("primary"),
        F.regexp_replace(by_sound, "[aeiouhy]", "").alias("secondary"),
    )


def codes_of(key: Column) -> Column:
    """The distinct non-empty codes of a key."""
    return F.filter(F.array_distinct(F.array(key["primary"], key["secondary"])), lambda c: c != "")
