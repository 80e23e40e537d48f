"""Folding and cleaning of text as Column expressions; every builder takes and returns a Column."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_pairs() -> tuple[str, str]:
    """Latin letters whose compatibility decomposition without marks is one other character, from a rule over U+00AA-U+024F and U+1E00-U+1EFF."""
    src, dst = [], []
    for code in (*range(0xAA, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code).casefold()
        if len(c) != 1 or c in src:
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c:
            src.append(c)
            dst.append(plain)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_pairs()
# What UTF-8 read as a legacy code page leaves in a text, controls besides.
MOJIBAKE_MARKS = "[ÃÂâð�\\x80-\\x9f]"
#: HTML's named entities of one character, by name, as one JSON object.
_ENTITIES = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";") and len(v) == 1})
#: Texts that fold by lower-casing alone; one plain word; texts that JSON takes as they are.
_ASCII = r"^[\x00-\x7f]*\z"
_WORD = r"^ *[A-Za-z0-9]+ *\z"
_UNESCAPED = r"^[ !#-\[\]-~]*\z"
_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);|[^&]+|&"


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """body of c's value, computed once however often body names it."""
    return F.transform(F.array(c), body)[0]


def unescape(c: Column) -> Column:
    """HTML entities, named or numbered, that end in a semicolon; each once, and what is no entity stays."""
    names = F.from_json(F.lit(_ENTITIES), "map<string,string>")  # constant

    def one(piece: Column) -> Column:
        body = F.substring(piece, 2, 64)  # from its second character on
        code = F.when(body.rlike("^#[0-9]"), F.regexp_extract(body, "[0-9]+", 0).try_cast("int")).when(body.rlike("^#[xX]"), F.conv(F.regexp_extract(body, "^#.([0-9a-fA-F]+)", 1), 16, 10).try_cast("int"))
        char = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        known = F.try_element_at(names, F.regexp_replace(body, ";$", ""))
        return F.when(piece.startswith("&") & piece.endswith(";"), F.coalesce(char, known, piece)).otherwise(piece)

    return F.when(c.contains("&"), F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0)), one), "")).otherwise(c)


def casefold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def strip_marks(c: Column) -> Column:
    """Accents off folded text, whether composed or written as combining marks."""
    return F.regexp_replace(F.translate(c, FOLD_FROM, FOLD_TO), r"\p{M}+", "")


def match_key(c: Column) -> Column:
    """Repaired, unescaped, folded, and only a-z and 0-9 kept."""
    return F.regexp_replace(strip_marks(casefold(unescape(repair_mojibake(c)))), "[^a-z0-9]+", "")


def fold_text(c: Column) -> Column:
    """Folded, with anything else as one space."""
    return F.trim(F.regexp_replace(strip_marks(casefold(repair_mojibake(c))), "[^a-z0-9]+", " "))


def fold_catalog(c: Column) -> Column:
    """Folded with punctuation kept."""
    return strip_marks(casefold(repair_mojibake(c)))


def stable_text(c: Column) -> Column:
    """Folded case and single spaces, for locators in identity keys."""
    return F.trim(F.regexp_replace(casefold(c), r"(?U)\s+", " "))


def attribute_key(c: Column) -> Column:
    """Snake case of an attribute name; null where nothing is left (an error for callers)."""
    folded = F.when(c.rlike(_ASCII), F.lower(c)).otherwise(strip_marks(casefold(c)))
    snake = let(F.btrim(F.regexp_replace(folded, "[^a-z0-9]+", "_"), F.lit("_")), lambda key: F.when(key != "", key))
    return F.when(c.rlike(_WORD), F.lower(F.trim(c))).otherwise(snake)


def mojibake_score(c: Column) -> Column:
    return F.regexp_count(c, F.lit(MOJIBAKE_MARKS))


def _cp1252_specials() -> tuple[str, str]:
    """Windows-1252's printable characters at 0x80-0x9F and the Latin-1 controls at the same bytes."""
    src = dst = ""
    for b in range(0x80, 0xA0):
        try:
            src += bytes([b]).decode("cp1252")
            dst += chr(b)
        except UnicodeDecodeError:
            pass
    return src, dst


_CP_FROM, _CP_TO = _cp1252_specials()
#: What is one byte a character in Latin-1, or in Windows-1252.
_ONLY_BYTES = "^(?:[\\x00-\\xff]*|[\\x00-\\x7f\\xa0-\\xff" + "".join(f"\\x{{{ord(c):x}}}" for c in _CP_FROM) + "]*)$"


def repair_mojibake(c: Column, rounds: int = 3) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252, read again; a round counts only if fewer marks remain."""

    def once(x: Column) -> Column:
        raw = F.encode(F.translate(x, _CP_FROM, _CP_TO), "ISO-8859-1")
        again = F.when(x.rlike(_ONLY_BYTES) & F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
        return let(again, lambda y: F.when(mojibake_score(y) < mojibake_score(x), y).otherwise(x))

    def all_rounds(x: Column) -> Column:
        out = x
        for _ in range(rounds):
            out = let(out, once)
        return F.when(x.rlike(MOJIBAKE_MARKS), out).otherwise(x)

    return let(c, all_rounds)


def clean_text(c: Column) -> Column:
    """Repaired, all white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.replace(repair_mojibake(c), F.lit(" "), F.lit(" ")), r"(?U)\s+", " "))


def json_string(c: Column) -> Column:
    """A JSON string literal."""
    escaped = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return F.when(c.rlike(_UNESCAPED), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(escaped)


def canonical_json(m: Column) -> Column:
    """A map of strings as JSON with sorted keys and spaced separators."""
    pair = F.transform(F.sort_array(F.map_entries(m)), lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_string(e["value"])))
    return F.concat(F.lit("{"), F.array_join(pair, ", "), F.lit("}"))


def stringify(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))
