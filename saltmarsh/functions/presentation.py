"""Sizes at the end of names: quantity and unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import number_text, price_number
from .text import casefold, let, match_key, repair_mojibake, unescape

# The unit that each spelling stands for; there is no conversion between units. Attributes that tell a size.
UNITS = {"g": "g", "gr": "g", "grs": "g", "kg": "kg", "kgs": "kg", "ml": "ml", "l": "l", "lt": "l", "oz": "oz", "u": "u", "ud": "u", "uds": "u", "unidad": "u", "unidades": "u"}
ATTRIBUTE_KEYS = ("presentacion", "presentation", "tamano", "size", "volumen", "volume")
# Prices (the currency after the number) and sizes inside a description.
PRICE = r"(?iU)\b\d+(?:[.,]\d+)?\s*(?:bs\.?|b\.s\.?)\b"
SIZE = r"(?iU)\b\d+(?:[.,]\d+)?\s*(?:ml|grs?|kg|lt|l)\b"
_SUFFIX = r"([0-9]+(?:[.,][0-9]+)?)\s*(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")?\s*$"


def unit(c: Column) -> Column:
    """The unit that a spelling stands for; an unknown one is itself, folded to its key; none is empty."""
    key = match_key(F.coalesce(c, F.lit("")))
    return let(key, lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair]), k), k))


def signature(c: Column) -> Column:
    """struct(quantity string, unit string) of the trailing size; null without one. The unit may be empty."""

    def of(t: Column) -> Column:
        said = F.regexp_extract(t, _SUFFIX, 2)
        known = said
        for spelling, name in UNITS.items():
            known = F.when(said == spelling, name).otherwise(known)
        quantity = number_text(price_number(F.nullif(F.regexp_extract(t, _SUFFIX, 1), F.lit(""))))
        return let(quantity, lambda q: F.when(q.isNotNull(), F.struct(q.alias("quantity"), known.alias("unit"))))

    # most names end otherwise: those are told by one pattern before anything is bound
    return F.when(c.rlike(r"(?i)[0-9]\s*[a-z]{0,8}\s*$"), let(F.trim(casefold(repair_mojibake(c))), of))


def same(a: Column, b: Column) -> Column:
    """Equal quantities, and equal units unless one side names none."""
    return (a["quantity"] == b["quantity"]) & same_unit(a["unit"], b["unit"])


def same_unit(a: Column, b: Column) -> Column:
    return (a == b) | (a == "") | (b == "")


def from_attributes(m: Column, keys: tuple[str, ...] = ATTRIBUTE_KEYS) -> Column:
    """The first attribute that tells a size, its name compared by match key."""
    return F.try_element_at(F.filter(F.map_entries(m), lambda e: match_key(e["key"]).isin(*keys)), F.lit(1))["value"]


def clean_fragment(c: Column) -> Column:
    """A description fragment without price and size tokens, and without space before punctuation."""
    t = F.replace(F.replace(repair_mojibake(unescape(c)), F.lit("\u00a0"), F.lit(" ")), F.lit("\ufb02"), F.lit("fl"))
    t = F.regexp_replace(F.regexp_replace(t, PRICE, " "), SIZE, " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)\s+([,.!?;:])", "$1"), r"(?U)\s+", " ")
    return F.regexp_replace(t, "^[ -]+|[ -]+$", "")
