"""Locale-aware parsing as Column expressions. The three number parsers differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import attribute_key, let

NUMBER = "decimal(38,10)"
# The words that stand for true and false.
TRUE_WORDS = ("1", "true", "verdadero", "si", "sí", "x", "y", "yes")
FALSE_WORDS = ("0", "false", "falso", "no", "n")
CURRENCY = r"(?i)^(bs\.?|usd|\$)"


def _plain(c: Column) -> Column:
    """Text with a decimal point that is a plain number, else null: no underscores, NaN or infinity."""
    return F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), c).try_cast(NUMBER)


def _comma_decimal(c: Column) -> Column:
    """With both marks, points group and the comma is decimal; a lone mark of either kind is decimal."""
    return F.when(c.contains(",") & c.contains("."), F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(c, F.lit(","), F.lit(".")))


def table_number(c: Column) -> Column:
    """Numbers of table cells: spaces go, then one leading currency sign. Unparsable text is null."""
    bare = F.regexp_replace(F.replace(F.trim(c), F.lit(" "), F.lit("")), CURRENCY, "")
    return let(let(bare, _comma_decimal), _plain)


def document_number(c: Column) -> Column:
    """Numbers in documents: as in tables, without a currency sign."""
    return let(let(F.replace(F.trim(c), F.lit(" "), F.lit("")), _comma_decimal), _plain)


def price_number(c: Column) -> Column:
    """Numbers of price lists: the first token that begins with a digit; of its marks the last is decimal; signs are lost."""

    def normal(token: Column) -> Column:
        def last(mark: str) -> Column:
            at = F.locate(mark, F.reverse(token))
            return F.when(at > 0, F.char_length(token) - at + 1).otherwise(F.lit(0))

        dots, commas = F.replace(token, F.lit("."), F.lit("")), F.replace(token, F.lit(","), F.lit(""))
        point = F.replace(token, F.lit(","), F.lit("."))
        both = token.contains(",") & token.contains(".")
        return F.when(both & (last(",") > last(".")), F.replace(dots, F.lit(","), F.lit("."))).when(both, commas).otherwise(point)

    return let(let(F.nullif(F.regexp_extract(c, r"([0-9][0-9.,]*)", 1), F.lit("")), normal), _plain)


def number_text(c: Column) -> Column:
    """Plain notation without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def boolean(c: Column) -> Column:
    """True and false words in two languages; anything else is null."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def date(c: Column) -> Column:
    """Three fixed orders with a four-digit year; nothing may follow."""
    t = F.trim(c)
    return F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "y-M-d")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "d/M/y")),
        F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(t, "d-M-y")),
    )


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


#: JSON values other than objects begin like this; pairs seldom do, and parsing them as JSON in vain is slow.
_MAYBE_JSON = r'^(?:\[|"|-?[0-9]|(?:true|false|null)$)'


def attributes(c: Column) -> Column:
    """struct(value map<string,string>, error string) of a JSON object of scalars, or of pairs.

    Pairs are parted by semicolon, bar or newline, and key from value by ``=`` or else ``:``. Keys are normalised before
    they are compared, so two spellings of one key are an error. Blank text is a null value without an error.
    """

    def key(p: Column) -> Column:
        return attribute_key(F.when(p.contains("="), F.substring_index(p, "=", 1)).when(p.contains(":"), F.substring_index(p, ":", 1)))

    def value(p: Column) -> Column:
        return F.trim(F.when(p.contains("="), F.substr(p, F.locate("=", p) + 1)).when(p.contains(":"), F.substr(p, F.locate(":", p) + 1)))

    def raw(keys: Column, values: Column, nested: Column) -> Column:
        return F.struct(keys.alias("keys"), values.alias("values"), nested.alias("nested"))  # nested: null of pairs

    def of_json(t: Column) -> Column:
        """An object's keys (duplicates kept) with their values; null if the text is none."""

        def taken(names: Column, held: Column) -> Column:
            said = F.transform(names, lambda k: F.element_at(held, k))
            return F.when(names.isNotNull(), raw(F.transform(names, attribute_key), F.transform(said, lambda v: F.trim(v)), F.exists(said, lambda v: F.coalesce(v.rlike(r"^\s*[\{\[]"), F.lit(False)))))

        return let(F.struct(F.json_object_keys(t).alias("names"), F.from_json(t, "map<string,string>").alias("held")), lambda o: taken(o["names"], o["held"]))

    def of_pairs(t: Column) -> Column:
        """The parts of a text; one without a mark has neither key nor value."""
        # one character to split at, so no pattern is compiled a row; a bare F.trim would take a part's index for the characters to trim
        pieces = F.split(F.replace(F.replace(t, F.lit("|"), F.lit(";")), F.lit("\n"), F.lit(";")), ";")
        parts = F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != "")
        return let(parts, lambda ps: raw(F.transform(ps, key), F.transform(ps, value), F.lit(None).cast("boolean")))

    def judge(t: Column, src: Column) -> Column:
        keys, values, is_object = src["keys"], src["values"], src["nested"].isNotNull()
        error = (
            F.when(is_blank(t), F.lit(None))
            .when(~is_object & t.rlike(_MAYBE_JSON) & F.try_parse_json(t).isNotNull(), F.when(t == "null", "invalid pair").otherwise("must be an object"))
            .when(F.exists(keys, lambda k: k.isNull()), "invalid pair")
            .when(F.exists(values, lambda v: v.isNull() | (v == "")), "empty value")
            .when(src["nested"], "nested value")
            .when((F.size(keys) > 1) & (F.size(F.array_distinct(keys)) < F.size(keys)), "duplicate key")
        )
        return let(error.cast("string"), lambda e: F.struct(F.when(e.isNull() & ~is_blank(t) & (F.size(keys) > 0), F.map_from_arrays(keys, values)).alias("value"), e.alias("error")))

    def read(t: Column) -> Column:  # only what begins as an object is parsed as one
        return let(F.coalesce(F.when(t.startswith("{"), of_json(t)), of_pairs(t)), lambda src: judge(t, src))

    return let(F.trim(c), read)
