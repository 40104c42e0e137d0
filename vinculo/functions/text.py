"""Text clean-up expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters NFKD cannot take apart, with their usual ASCII spelling (fixed values).
SPELLED_OUT = {
    "Æ": "AE", "æ": "ae", "Ø": "O", "ø": "o", "ß": "ss", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ĳ": "IJ", "ĳ": "ij", "Ł": "L", "ł": "l",
    "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "Ŋ": "NG", "ŋ": "ng", "ĸ": "k",
    "º": "o", "ª": "a", "×": "x", "÷": "/",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "€": "EUR",
}

# Blocks whose letters are a Latin base letter plus marks.
_MARKED_LATIN_BLOCKS = ((0x00C0, 0x0250), (0x1E00, 0x1F00))


def _marked_letters() -> dict[str, str]:
    """Map every marked Latin letter to its single ASCII base letter."""
    folds = {}
    for first, last in _MARKED_LATIN_BLOCKS:
        for letter in map(chr, range(first, last)):
            base = "".join(
                part for part in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(part)
            )
            if letter not in SPELLED_OUT and len(base) == 1 and base.isascii():
                folds[letter] = base
    return folds


_ONE_TO_ONE = {**_marked_letters(), **{k: v for k, v in SPELLED_OUT.items() if len(v) == 1}}
_ONE_TO_MANY = {k: v for k, v in SPELLED_OUT.items() if len(v) > 1}
_SPACES = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = r"\u0300-\u036f"


def _transliterate(text: Column) -> Column:
    folded = F.translate(text, "".join(_ONE_TO_ONE), "".join(_ONE_TO_ONE.values()))
    for letter, spelling in _ONE_TO_MANY.items():
        folded = F.replace(folded, F.lit(letter), F.lit(spelling))
    return F.regexp_replace(folded, f"[{_MARKS}]+", "")


def normalize_name(text: Column) -> Column:
    """Fold to unaccented capitals with single spaces; null stays null."""
    # Plain ASCII text, the common case, skips the folding passes.
    ascii_only = F.octet_length(text) == F.char_length(text)
    folded = F.when(ascii_only, text).otherwise(_transliterate(text))
    return F.upper(F.trim(F.regexp_replace(folded, f"[{_SPACES}]+", " ")))


def has_name(text: Column) -> Column:
    """True if :func:`normalize_name` leaves anything of the text, told without folding it."""
    return text.isNotNull() & text.rlike(f"[^{_SPACES}{_MARKS}]")


def digits_only(text: Column) -> Column:
    """Keep the ASCII digits; null stays null."""
    return F.regexp_replace(text, "[^0-9]+", "")


def is_present(value: Column) -> Column:
    """True for a value which is neither null nor the empty string."""
    return value.isNotNull() & (value != "")


def filled(value: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(value, F.lit(""))
