"""Tokenisers. Each takes a text column and gives ``array<string>``."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

TOPIC_TOKEN = r"[\p{L}\p{Nl}\p{No}_]+"
CV_TOKEN = "[a-z0-9]{3,}"
SIMILARITY_PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
NEGATION = "([a-z])n['’]t"

# ASCII punctuation.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Every lower-case accented letter of the basic plane and its bare letter, derived from Unicode decompositions."""
    accented, bare = [], []
    for code in range(0xC0, 0xFFFF):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF or char.lower() != char or not char.isalpha():
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        base = unicodedata.normalize("NFC", base)
        if len(base) == 1 and base != char:
            accented.append(char)
            bare.append(base)
    return "".join(accented), "".join(bare)


def strip_accents(col: Column) -> Column:
    """Lower-case text without accents, precomposed or combining. A text of ASCII has none and is left as it is."""
    accented, bare = accent_table()
    stripped = F.translate(F.regexp_replace(col, r"\p{Mn}", ""), accented, bare)
    return F.when(F.rlike(col, F.lit(r"[^\x00-\x7F]")), stripped).otherwise(col)


def tokenize_topic(col: Column, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-case, accent-free letter runs of 2 to 15 characters.

    The pattern itself asks for the length, as a function called on every word costs more than cutting the words. Every run is consumed whole;
    one that is too short, too long or starts with ``_`` leaves an empty string.
    """
    char = TOPIC_TOKEN.removesuffix("+")
    wanted = f"(?!_)({char}{{{min_len},{max_len}}}+)(?!{char})|{char}++"
    return F.array_remove(F.regexp_extract_all(strip_accents(F.lower(col)), F.lit(wanted), F.lit(1)), "")


def tokenize_similarity(col: Column) -> Column:
    """Lower-case whitespace tokens, punctuation kept, all-digit tokens dropped.

    All-digit tokens, also before a separator of lines that is no whitespace, are consumed and leave an empty string.
    """
    return F.array_remove(F.regexp_extract_all(F.lower(col), F.lit(r"[0-9]++[\x85\u2028\u2029]?(?!\S)|(\S++)"), F.lit(1)), "")


def split_punctuation(tokens: Column) -> Column:
    """Words and single punctuation marks; a contracted negation becomes the word ``not``."""
    text = F.regexp_replace(F.array_join(tokens, " "), NEGATION, "$1 not")
    return F.regexp_extract_all(text, F.lit(SIMILARITY_PIECE), F.lit(0))


def tokenize_cv(col: Column) -> Column:
    """Lower-case runs of three or more ASCII letters or digits; a joined pair falls apart again."""
    return F.regexp_extract_all(F.lower(col), F.lit(CV_TOKEN), F.lit(0))


def remove_punctuation(col: Column) -> Column:
    return F.regexp_replace(col, PUNCTUATION, "")
