"""From source columns to canonical fields: header matching on the driver (names only), parsing in one projection."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..schema import Field, fields_for
from .validation import issue

#: A fuzzy match needs this ratio, and this lead over the next candidate.
LEAST_RATIO, LEAST_LEAD = 0.82, 0.04


def header_key(name: str) -> str:
    """ASCII letters and digits of a header, lower case."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    return "".join(c for c in plain if c.isalnum())


def suggest(headers: list[str], entity: str) -> dict[str, str]:
    """Header -> field by equal name or alias, else by a clear fuzzy match; each field once, headers in order."""
    candidates = [(header_key(x), f.name) for f in fields_for(entity) for x in (f.name, *f.aliases)]
    taken: dict[str, str] = {}
    for header in headers:
        key = header_key(header)
        exact = next((name for k, name in candidates if k == key), None)
        if exact is None and key:
            scored = sorted(((difflib.SequenceMatcher(None, key, k).ratio(), name) for k, name in candidates), reverse=True)
            lead = scored[0][0] - (scored[1][0] if len(scored) > 1 else 0)
            if scored[0][0] >= LEAST_RATIO and lead >= LEAST_LEAD:
                exact = scored[0][1]
        if exact and exact not in taken.values():
            taken[header] = exact
    return taken


def check(mapping: Mapping[str, str], headers: list[str], entity: str) -> None:
    """Unknown destinations, then missing headers, then repeated destinations are errors."""
    names = {f.name for f in fields_for(entity)}
    if unknown := sorted(set(mapping.values()) - names):
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    if missing := [h for h in mapping if h not in headers]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if len(set(mapping.values())) < len(mapping):
        raise ValueError("a field is mapped twice")


def drop_blank(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with some cell that is not blank; row numbers given at the source still count the rest."""
    return df.where(F.exists(F.array(*[F.col(f"`{c}`").cast("string") for c in columns or df.columns]), lambda c: ~parse.is_blank(c)))


def limit_rows(df: DataFrame, most: int) -> DataFrame:
    """df, or an error if it has more rows."""
    if most <= 0:
        raise ValueError("the row limit must be positive")
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")
    return df


def parsed(field: Field, source: Column) -> tuple[Column, Column]:
    """(value, whether it failed): blank numbers and booleans are null, a blank date is an error."""
    if field.type == "number":
        value = parse.table_number(source)
        return value, ~parse.is_blank(source) & value.isNull()
    if field.type == "boolean":
        value = parse.boolean(source)
        return value, ~parse.is_blank(source) & value.isNull()
    if field.type == "date":
        value = parse.date(source)
        return value, source.isNotNull() & value.isNull()
    if field.type == "attributes":
        both = parse.attributes(source)
        return both["value"], both["error"].isNotNull()
    return F.nullif(F.trim(source), F.lit("")), F.lit(False)


def apply(df: DataFrame, mapping: Mapping[str, str], entity: str, defaults: Mapping[str, object] | None = None, keep: tuple[str, ...] = ("row_number",)) -> DataFrame:
    """Typed fields, null where the source has none, and ``coercion``: the parsing errors of each row.

    Defaults stand in for nulls as they are, neither parsed nor checked.
    """
    check(mapping, df.columns, entity)
    by_field = {f: h for h, f in mapping.items()}
    columns, errors = [], []
    for f in fields_for(entity):
        default = (defaults or {}).get(f.name)
        if f.name in by_field:
            value, failed = parsed(f, F.col(f"`{by_field[f.name]}`").cast("string"))
            errors.append(issue("invalid_type", f.name, failed))
            columns.append((F.coalesce(value, F.lit(default)) if default is not None else value).alias(f.name))
        elif default is not None:
            columns.append(F.lit(default).alias(f.name))
    return df.select(*keep, *columns, F.array_compact(F.array(*errors)).alias("coercion"))


def preview(df: DataFrame, entity: str, rows: int = 5) -> dict[str, object]:
    """Headers, suggested mapping, the first rows and the row count."""
    data = [c for c in df.columns if c not in ("row_number", "source_file")]
    return {"headers": data, "mapping": suggest(data, entity), "sample": [r.asDict() for r in df.orderBy("row_number").limit(rows).collect()], "total_rows": df.count()}
