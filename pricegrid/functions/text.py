"""Text helpers as Column expressions."""

from __future__ import annotations

import html
import unicodedata

from pyspark.sql import Column, functions as F

# Cell texts a CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Latin letters that no accent tells from another one.
STROKES = {"ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "ĸ": "k", "ƶ": "z", "ɨ": "i", "ƀ": "b", "ǥ": "g"}


def _accents() -> tuple[str, str]:
    """Lower-case Latin letters with accents, and the letters below the accents."""
    plain = dict(STROKES)
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if chr(code).islower() and base.isascii() and base.isalpha():
            plain[chr(code)] = base
    return "".join(plain), "".join(plain.values())


ACCENTED, PLAIN = _accents()

# What Python calls white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank, ends are stripped."""
    return strip(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def null_token(text: Column) -> Column:
    """NULL for the texts that mean "missing"."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def fold(text: Column) -> Column:
    """Lower case without accents, whether they are part of a letter or follow it."""
    return F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{M}+", "")


def tokens(text: Column) -> Column:
    """Distinct folded words of a text in any script, in order of first appearance."""
    words = F.split(fold(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda word: word != ""))


def fingerprint(text: Column) -> Column:
    """Spelling-independent key: folded distinct words in sorted order."""
    return F.array_join(F.array_sort(tokens(text)), " ")


def decode_entities(text: Column) -> Column:
    """Decode all entities that end with a semicolon, once: "&amp;lt;" becomes "&lt;".

    Names are those of the standard library. Numbers follow web pages: 128 to
    159 mean Windows-1252, and what is no character becomes a replacement.
    """
    entity = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
    between = F.split(text, entity, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(entity), F.lit(1)), _decoded)
    pieces = F.zip_with(between, found, lambda before, char: F.concat(before, F.coalesce(char, F.lit(""))))
    return F.when(text.rlike(entity), F.array_join(pieces, "")).otherwise(text)


def _decoded(name: Column) -> Column:
    names = {k.removesuffix(";"): v for k, v in html.entities.html5.items() if k.endswith(";")}
    hexadecimal = name.rlike("^#[xX]")
    digits = F.regexp_replace(name, "^#[xX]?", "")
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    windows = {c: bytes([c]).decode("cp1252") for c in range(128, 160) if bytes([c]).decode("cp1252", "ignore")}
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    number = F.coalesce(F.try_element_at(_literal(windows), code.cast("string")), F.when(valid, char).otherwise("\ufffd"))
    known = F.try_element_at(_literal(names), name)
    return F.when(name.startswith("#"), number).otherwise(F.coalesce(known, F.concat(F.lit("&"), name, F.lit(";"))))


def _literal(table: dict) -> Column:
    """A map as one constant."""
    keys, values = zip(*((str(k), v) for k, v in table.items()))
    joined = lambda texts: F.split(F.lit("\x00".join(texts)), "\x00")
    return F.map_from_arrays(joined(keys), joined(values))
