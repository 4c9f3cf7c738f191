"""Text normalisers (F01 names, F02 outcome texts) as native Column expressions.

Spark has no Unicode normalisation function, so accent folding is a
``translate`` table generated here from ``unicodedata`` (every precomposed
Latin letter whose canonical decomposition is an ASCII base letter plus
combining marks), followed by a ``\\p{Mn}`` sweep for marks that arrive
already decomposed.  F02's transliteration (Latin, Greek, Cyrillic) looks up
each code point of a text once, in an array made from decompositions and the
letters below; an ASCII text is left as it is.  No UDF.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code-point ranges scanned for precomposed Latin letters.
_LATIN_RANGES = [(0x00C0, 0x0250), (0x1E00, 0x1F00)]

# Letters with no canonical decomposition that a Latin-to-ASCII
# transliterator spells out (lower case; F02 lower-cases first), and signs.
# FIXED VALUES: public Latin transliteration
_LOWER_EXPANSIONS = [
    ("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ð", "d"),
    ("ł", "l"), ("þ", "th"), ("ħ", "h"), ("ı", "i"), ("ŧ", "t"), ("ŋ", "ng"),
    ("ĳ", "ij"), ("ſ", "s"),
    ("ª", "a"), ("º", "o"), ("°", "deg"), ("¹", "1"), ("²", "2"), ("³", "3"),
    ("µ", "u"), ("×", "x"), ("©", "(c)"), ("®", "(r)"),
]

# Public romanisation of lower-case Greek and Cyrillic letters.
_GREEK = "α a β b γ g δ d ε e ζ z η e θ th ι i κ k λ l μ m ν n ξ x ο o π p ρ r σ s ς s τ t υ u φ ph χ kh ψ ps ω o"
_CYRILLIC = ("а a б b в v г g д d е e ж zh з z и i к k л l м m н n о o п p р r с s т t у u ф f х kh ц ts ч ch ш sh щ shch "
             "ъ \" ы y ь ' э e ю iu я ia ё io є ie і i ї yi ј j љ lj њ nj ћ c ђ dj џ dzh ѓ gj ќ kj ѕ dz ґ g' ў u")
# end of FIXED VALUES


@lru_cache(maxsize=None)
def fold_table() -> tuple[str, str]:
    """(from_chars, to_chars) for ``translate``: precomposed letter -> ASCII base."""
    src, dst = [], []
    for lo, hi in _LATIN_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            decomp = unicodedata.normalize("NFD", ch)
            if len(decomp) < 2:
                continue
            base, marks = decomp[0], decomp[1:]
            if base.isascii() and base.isalpha() and all(unicodedata.category(m) == "Mn" for m in marks):
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def fold_accents(c: Column) -> Column:
    src, dst = fold_table()
    return F.regexp_replace(F.translate(c, src, dst), r"\p{Mn}", "")


def clean_name(c: Column) -> Column:
    """upper, strip accents, ``[-.,]`` -> space, keep only A-Z and space,
    collapse spaces, empty -> null.  Tabs/newlines vanish without a space."""
    upper = F.upper(c)
    s = F.when(is_ascii(upper), upper).otherwise(F.translate(upper, *fold_table()))
    for sign in "-.,":
        s = F.replace(s, F.lit(sign), F.lit(" "))
    s = F.regexp_replace(s, r"[^A-Z ]+", "")  # marks of decomposed letters too
    # null stays null by itself; within a branch for it, all of this would be worked out twice (for the test and the result)
    return F.nullif(F.trim(F.regexp_replace(s, r" {2,}", " ")), F.lit(""))


_FIRST, _LAST = 0x80, 0x1FFF  # code points of the lookup


@lru_cache(maxsize=None)
def romanised() -> list[str]:
    """For each code point of the lookup what it becomes: the fixed values, else
    its base letter's, nothing for a combining mark, else itself."""
    fixed = dict(_LOWER_EXPANSIONS)
    for pairs in (_GREEK, _CYRILLIC):
        words = pairs.split()
        fixed.update(zip(words[::2], words[1::2]))
    out = []
    for cp in range(_FIRST, _LAST + 1):
        ch = chr(cp)
        base, *marks = unicodedata.normalize("NFD", ch)
        known = base in fixed or (base.isascii() and base.isalpha())
        if ch in fixed:
            out.append(fixed[ch])
        elif unicodedata.category(ch) == "Mn":
            out.append("")
        elif known and all(unicodedata.category(m) == "Mn" for m in marks):
            out.append(fixed.get(base, base))
        else:
            out.append(ch)
    return out


@lru_cache(maxsize=None)
def romanised_signs() -> tuple[str, str]:
    """(from_chars, to_chars) for ``translate``: the code points of the lookup
    that become one other sign, then (no counterpart) those that vanish."""
    pairs = [(chr(cp), to) for cp, to in enumerate(romanised(), _FIRST) if to != chr(cp)]
    single = [p for p in pairs if len(p[1]) == 1]
    return "".join(a for a, _ in single) + "".join(a for a, to in pairs if not to), "".join(to for _, to in single)


def transliterate_lower(c: Column) -> Column:
    """Transliteration of already lower-cased text.  Code points that become
    one sign at most are translated; only a text that holds others still is
    looked up code point by code point."""
    return spelled_out(translated(c))


def translated(c: Column) -> Column:
    """First step of ``transliterate_lower``; a plan that has it in a column of
    its own works it out once."""
    return F.when(is_ascii(c), c).otherwise(F.translate(c, *romanised_signs()))


def spelled_out(c: Column) -> Column:
    """Second step of ``transliterate_lower``, over the first."""
    return F.when(is_ascii(c), c).otherwise(_looked_up(c))


def _looked_up(c: Column) -> Column:
    table = F.split(F.lit("\ue000".join(romanised())), "\ue000")  # a constant, folded once a plan
    looked = F.transform(F.split(c, ""), lambda ch: F.coalesce(F.get(table, F.ascii(ch) - _FIRST), ch))
    return F.regexp_replace(F.array_join(looked, ""), r"\p{Mn}", "")


def clean_outcome_text(c: Column) -> Column:
    """null -> ''; lower; transliterate; ``_``/``-`` -> space; anything
    outside ``[a-z0-9\\s]`` -> space; collapse whitespace; trim."""
    return outcome_signs(transliterate_lower(F.lower(c)))


def outcome_signs(c: Column) -> Column:
    """F02 over a transliterated text."""
    # signs that become a space and white space collapse alike, so one pass does all three steps
    return F.coalesce(F.trim(F.regexp_replace(c, r"[^a-z0-9]+", " ")), F.lit(""))


def with_clean_outcome(df: DataFrame, src: str, out: str) -> DataFrame:
    """F02 as a DataFrame step: each step projected once."""
    return (df.select("*", F.lower(F.col(src)).alias("_f02_low"))
              .select("*", translated(F.col("_f02_low")).alias("_f02_signs"))
              .withColumn(out, outcome_signs(spelled_out(F.col("_f02_signs"))))
              .drop("_f02_low", "_f02_signs"))


# The whitespace set of ``\s`` (space, tab, newline, vertical tab, form feed, CR).
_BLANKS = " \t\n\x0b\f\r"


def strip_blanks(c: Column) -> Column:
    """Trim leading/trailing whitespace of every kind (Spark ``trim``
    only removes spaces); a character-set trim, no regex."""
    return F.btrim(c, F.lit(_BLANKS))


def placeholder_to_null(c: Column, placeholders: list[str]) -> Column:
    """Configured placeholder strings become null."""
    return F.when(c.isin(placeholders), F.lit(None).cast("string")).otherwise(c)
