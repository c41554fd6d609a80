"""Text functions (F1-F5, F12, F13, X10, X12, P3, P4) as columns.

Normalization stays on the JVM for everything up to U+024F: single letters go through ``translate``, letters that become
several go through ``replace``.  Only texts with other characters meet a Python function, which gets NULL for the rest.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that NFKD does not take apart, and how they are written in ASCII.
LETTERS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th",
    "Þ": "Th", "ı": "i", "ħ": "h", "Ħ": "H", "ŋ": "ng", "Ŋ": "NG", "ŧ": "t", "Ŧ": "T", "ĸ": "q", "ə": "@", "Ə": "@", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "×": "x", "÷": "/", "«": "<<", "»": ">>", "©": "(c)", "®": "(r)", "°": "deg",
    "¡": "!", "¿": "?", "€": "EUR", "£": "PS", "¥": "Y=", "§": "SS", "¶": "P", "·": "*", "±": "+-", "¬": "!", "¢": "C/", "¤": "$?", "¦": "|",
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e",
    "ю": "iu", "я": "ia", "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}


def _by_name(letter: str) -> str:
    """A letter of a script without a table, by the last word of its Unicode name: KA of DEVANAGARI LETTER KA.

    Consonants of scripts that do not write vowels are spelled out there (MEEM), so these lose what follows.  Ideographs
    have no spelling in their names and become their code point, which keeps different ones apart.
    """
    name = unicodedata.name(letter, "")
    if name.startswith("CJK "):
        return f"u{ord(letter):x} "
    if not unicodedata.category(letter).startswith("L") or " " not in name:
        return ""
    sound = name.split(" WITH ")[0].rsplit(" ", 1)[1].lower()
    if not sound.isalpha():
        return f"u{ord(letter):x}"
    if name.startswith(("ARABIC ", "HEBREW ", "SYRIAC ")):
        return "a" if sound in ("alef", "alaph") else sound[:2] if sound[:2] in ("sh", "th", "kh", "gh", "dh", "ts") else sound[0]
    return sound


def transliterate(text: str) -> str:
    """Text in ASCII: compatibility decomposition without marks, then ``LETTERS``, then the letters' names.

    Latin, Greek and Cyrillic have a table; of other scripts each letter gives what ``_by_name`` reads from its name.
    """
    if text.isascii():
        return text
    out = []
    for c in text:
        if c in LETTERS:
            out.append(LETTERS[c])
            continue
        for part in unicodedata.normalize("NFKD", c):
            if part.isascii():
                out.append(part)
            elif part in LETTERS:
                out.append(LETTERS[part])
            elif part.lower() in LETTERS and part.lower() != part:
                out.append(LETTERS[part.lower()].capitalize())
            else:
                out.append(_by_name(part))
    return "".join(out)


def _latin_tables() -> tuple[str, str, dict[str, str], str]:
    """For U+0080 to U+024F: letters that become one, what they become, those that become several, those that vanish."""
    single, becomes, several, gone = [], [], {}, []
    for code in range(0x80, 0x250):
        plain = transliterate(chr(code))
        if len(plain) == 1:
            single.append(chr(code))
            becomes.append(plain)
        elif plain:
            several[chr(code)] = plain
        else:
            gone.append(chr(code))
    return "".join(single), "".join(becomes), several, "".join(gone)


_SINGLE, _BECOMES, _SEVERAL, _GONE = _latin_tables()
_NATIVE = "^[\\x00-\\u024F]*$"


def transliterate_latin(text: Column) -> Column:
    """``transliterate`` of texts without characters beyond U+024F, on the JVM."""
    spelled = text
    for letter, plain in _SEVERAL.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(plain))
    # few texts hold such a letter, and one look tells
    out = F.when(text.rlike(f"[{''.join(_SEVERAL)}]"), spelled).otherwise(text)
    return F.when(text.rlike("^[\\x00-\\x7F]*$"), text).otherwise(F.translate(out, _SINGLE + _GONE, _BECOMES))


def normalize_ingest(text: str) -> str:
    """transliterate, lower, drop all but word characters and white space, trim."""
    return re.sub(r"[^\w\s]", "", transliterate(text).lower()).strip()


def normalize_query(text: str) -> str:
    """as F1, but text without any character up to U+024F is not transliterated."""
    if any(c <= "ɏ" for c in text):
        text = transliterate(text)
    return re.sub(r"[^\w\s]", "", text.lower()).strip()


@F.pandas_udf(T.StringType())
def _ingest_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else normalize_ingest(x))


@F.pandas_udf(T.StringType())
def _query_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else normalize_query(x))


#: White space of ASCII as Python has it; the JVM's own leaves U+001C to U+001F out.
_SPACE = "[\\s\\x1c-\\x1f]"


def _trimmed(text: Column) -> Column:
    """Without white space at both ends, tabs and newlines included."""
    return F.regexp_replace(text, f"^{_SPACE}+|{_SPACE}+$", "")


def _native(text: Column) -> Column:
    return _trimmed(F.regexp_replace(F.lower(transliterate_latin(text)), "[^\\w\\s\\x1c-\\x1f]", ""))


def normalized(text: Column, at: str = "query") -> Column:
    """F1 (``at="ingest"``) or F2 (``at="query"``) of a column; NULL stays NULL."""
    inside = text.rlike(_NATIVE)
    slow = (_ingest_udf if at == "ingest" else _query_udf)(F.when(~inside, text))
    return F.when(inside, _native(text)).otherwise(slow)


def normalized_latin(text: Column) -> Column:
    """F1 and F2 where no character lies beyond U+024F: no Python at all; other texts give NULL."""
    return F.when(text.rlike(_NATIVE), _native(text))


def affiliation_key(name: Column) -> Column:
    """The stored lookup key."""
    return F.lower(F.trim(F.coalesce(name, F.lit(""))))


#: What may stand before a DOI, in the order in which they are tried.
DOI_PREFIXES = [
    "https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/", "https://www.doi.org/", "http://www.doi.org/", "doi.org/", "dx.doi.org/",
    "www.doi.org/", "doi:",
]
_DOI = r"^(10\.[0-9]{4,}(?:\.[0-9]+)?/[-._;()/:a-zA-Z0-9]+)(?:\s|$)"


def _stripped(text: Column, signs: str) -> Column:
    return F.btrim(text, F.lit(signs))


def clean_doi(text: Column) -> Column:
    """the DOI in what a user typed, or NULL; letters keep their case."""
    bare = _stripped(_stripped(_stripped(_trimmed(text), "<>"), '"'), "'")
    ahead = "(?i)^(?:" + "|".join(re.escape(p) for p in DOI_PREFIXES) + ")"
    cut = _trimmed(F.substring_index(F.substring_index(F.regexp_replace(bare, ahead, ""), "?", 1), "#", 1))
    loose = F.when(cut.startswith("10.") & cut.contains("/"), F.regexp_replace(cut, "[.,;:]+$", ""))
    return F.when(cut.rlike(_DOI), F.regexp_extract(cut, _DOI, 1)).otherwise(loose)


def doi_of_url(doi: Column) -> Column:
    """One exact leading ``https://doi.org/`` goes."""
    return F.regexp_replace(doi, "^https://doi\\.org/", "")


def doi_prefix(doi: Column) -> Column:
    """What stands before the first slash; '' without one."""
    return F.when(F.coalesce(doi, F.lit("")).contains("/"), F.substring_index(doi, "/", 1)).otherwise(F.lit(""))


def is_likely_acronym(text: Column) -> Column:
    """at most five characters and all cased ones upper, as it is or without dots and hyphens."""
    bare = F.btrim(text)

    def short_upper(x: Column) -> Column:
        return (F.char_length(x) <= 5) & (F.upper(x) == x) & (F.lower(x) != x)

    return F.coalesce(short_upper(bare) | short_upper(F.regexp_replace(bare, "[.-]", "")), F.lit(False))


def authors_of(cell: Column, separator: str) -> Column:
    """the trimmed, non-empty names of a cell as an array; without a separator the whole cell is one name."""
    whole = F.trim(cell)
    names = F.array(whole) if separator == "" else F.split(whole, "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)
    return F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != "")


def lossy_int(text: Column) -> Column:
    """A whole number, or NULL; fractions round half away from zero as the reference's engine does."""
    return F.coalesce(text.try_cast("int"), F.round(text.try_cast("double")).try_cast("int"))


def path_index(path: Column, step: str) -> Column:
    """the first index behind ``step`` in a path, or NULL where there is none or it is no int."""
    return F.regexp_extract(path, step + r"\[([0-9]+)\]", 1).try_cast("int")
