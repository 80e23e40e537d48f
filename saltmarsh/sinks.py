"""Sinks: JSON lines, Parquet with the declared schema, CSV, HTML rows; all as projections before a plain Spark write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.parse import number_text
from .functions.text import canonical_json, json_string
from .schema import data_schema, fields_for


def html_escape(c: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def json_value(c: Column, kind: str) -> Column:
    """A value as JSON text: booleans and integers as such, decimals exactly, as strings; maps as objects with sorted keys."""
    if kind in ("boolean", "int", "bigint", "smallint", "tinyint"):
        return c.cast("string")
    if kind.startswith("map"):
        return canonical_json(c)
    return json_string(number_text(c) if kind.startswith("decimal") else c.cast("string"))


def json_lines(df: DataFrame, columns: list[str] | None = None, name: str = "value") -> DataFrame:
    """df's columns as one JSON object a row, keys sorted, nulls left out."""
    kinds = dict(df.dtypes)
    said = [F.when(F.col(c).isNotNull(), F.concat(json_string(F.lit(c)), F.lit(": "), json_value(F.col(c), kinds[c]))) for c in sorted(columns or df.columns)]
    return df.withColumn(name, F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*said)), ", "), F.lit("}")))


def typed(df: DataFrame, entity: str) -> DataFrame:
    """All declared fields of the entity, those that df lacks as nulls."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in data_schema(entity)], *[c for c in df.columns if c not in data_schema(entity).names])


def write_processed(valid: DataFrame, entity: str, path: str, run_id: str, row: str = "row_number") -> None:
    """Parquet and JSON lines of valid records, with the run and the source row; the schema is the same for empty runs."""
    out = typed(valid, entity).select(*[f.name for f in fields_for(entity)], F.lit(run_id).alias("_run_id"), F.col(row).cast("long").alias("_source_row"))
    out.write.mode("overwrite").parquet(f"{path}/{entity}.parquet")
    json_lines(out).select("value").write.mode("overwrite").text(f"{path}/{entity}.jsonl")


def csv_text(df: DataFrame, entity: str, present_only: bool = True) -> DataFrame:
    """Fields in canonical order as text; with present_only, just those that some record has (none at all is an error)."""
    names = [f.name for f in fields_for(entity) if f.name in df.columns or not present_only]
    if present_only:
        seen = df.agg(F.count("*").alias("_n"), *[F.count(n).alias(n) for n in names]).first()
        names = [n for n in names if seen[n]]
        if seen["_n"] and not names:
            raise ValueError("no field has a value")
    kinds = {f.name: f.type for f in fields_for(entity)}

    def said(n: str) -> Column:
        if n not in df.columns:
            return F.lit("")
        return F.coalesce(canonical_json(F.col(n)) if kinds[n] == "attributes" else F.col(n).cast("string"), F.lit(""))

    return df.select(*[said(n).alias(n) for n in names])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(spark: SparkSession, df: DataFrame, entity: str) -> None:
    """One warehouse table an entity, replaced as a whole."""
    df.write.mode("overwrite").saveAsTable(f"normalized_{entity}")


def category_csv(entries: DataFrame) -> DataFrame:
    """The five columns of a category file, as text."""
    return entries.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("categoria", "producto_referencia", "source_file", "page_number", "source_block_id")])


def source_shaped(df: DataFrame, headers: list[str]) -> DataFrame:
    """df under the headers that a source came with, in their order, as text: other columns are left out, missing ones are empty."""
    kinds = dict(df.dtypes)

    def said(h: str) -> Column:
        if h not in kinds:
            return F.lit("")
        return F.coalesce(canonical_json(F.col(h)) if kinds[h].startswith("map") else number_text(F.col(h)) if kinds[h].startswith("decimal") else F.col(h).cast("string"), F.lit(""))

    return df.select(*[said(h).alias(h) for h in headers])


def review_rows(reviewed: DataFrame) -> DataFrame:
    """flows.review() as rows of a page's table, escaped, in the order they come in."""
    cell = "<td>", "</td>"
    cells = [F.concat(F.lit(cell[0]), html_escape(F.col(c)), F.lit(cell[1])) for c in ("marca", "nombre")]
    status = html_escape(F.col("status"))
    cells.append(F.concat(F.lit('<td class="status-'), status, F.lit('">'), status, F.lit(cell[1])))
    cells.append(F.concat(F.lit(cell[0]), html_escape(F.col("flags")), F.lit(cell[1])))
    cells.append(F.concat(F.lit('<td class="description">'), html_escape(F.col("descripcion")), F.lit(cell[1])))
    return reviewed.select("row_number", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("html"))


HEAD = '<!doctype html>\n<html lang="es"><head><meta charset="utf-8"><title>Revisión de descripciones</title></head><body>\n<table><thead><tr><th>Marca</th><th>Nombre</th><th>Estado</th><th>Flags</th><th>Descripción</th></tr></thead><tbody>\n'
FOOT = "</tbody></table></body></html>\n"


def write_review(rows: DataFrame, path: str) -> None:
    """The review page in one file on the driver's disk, streamed a partition at a time."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEAD)
        for r in rows.toLocalIterator():
            f.write(r.html + "\n")
        f.write(FOOT)
