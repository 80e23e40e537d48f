"""Validation of typed records: every rule a Column, repeated identities counted map-side, rows routed by their issues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import is_blank
from ..functions.text import canonical_json
from ..schema import fields_for

ISSUE = "struct<code:string,field:string,severity:string>"
PRODUCT_TYPES = ("simple", "variable", "servicio")
NON_NEGATIVE = ("precio", "precio_comparacion", "costo", "peso", "stock", "stock_minimo")


def issue(code: str, field: str | None, when: Column, severity: str = "error") -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(field).cast("string").alias("field"), F.lit(severity).alias("severity"))).cast(ISSUE)


def identity(entity: str, columns: list[str]) -> Column:
    """What makes two records the same; null where a record has no identity."""

    def has(name: str) -> Column:
        return F.nullif(F.trim(F.col(name).cast("string")), F.lit("")) if name in columns else F.lit(None).cast("string")

    if entity == "productos":
        return has("sku")
    if entity == "variantes":
        attrs = canonical_json(F.coalesce("atributos", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))) if "atributos" in columns else F.lit("{}")
        return F.concat_ws("|", has("sku_producto"), attrs) if "sku_producto" not in columns else F.when(has("sku_producto").isNotNull(), F.concat_ws("|", has("sku_producto"), attrs))
    if entity == "precios":
        return F.concat_ws("|", *[F.coalesce(has(c), F.lit("")) for c in ("sku", "sku_variante", "lista")])
    return F.coalesce(*[has(c) for c in ("celular", "email", "nombre")])


@dataclass(frozen=True)
class Validated:
    """rows: every record with issues (errors) and warnings; valid and quarantine: its two routes."""

    rows: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.rows.where(F.size("issues") == 0).drop("issues", "warnings", "first_row")

    @property
    def quarantine(self) -> DataFrame:
        return self.rows.where(F.size("issues") > 0).drop("first_row")

    def report(self) -> DataFrame:
        """One row: counts, and whether the run may be published."""
        bad = F.size("issues") > 0
        totals = self.rows.agg(
            F.count("*").alias("total_rows"),
            F.count_if(~bad).alias("valid_rows"),
            F.count_if(bad).alias("invalid_rows"),
            F.coalesce(F.sum(F.size("issues")), F.lit(0)).cast("long").alias("blocking_errors"),
            F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("long").alias("warnings"),
        )
        return totals.withColumn("approved_for_publish", (F.col("invalid_rows") == 0) & (F.col("total_rows") > 0))


def rules(entity: str, columns: list[str]) -> list[Column]:
    """Row rules in their fixed order: required, product type or attributes, signs."""
    out = []
    for f in fields_for(entity):
        if f.required:
            missing = is_blank(F.col(f.name).cast("string")) if f.name in columns and f.type != "attributes" else (F.col(f.name).isNull() if f.name in columns else F.lit(True))
            out.append(issue("required_field_missing", f.name, missing))
    if entity == "productos" and "tipo" in columns:
        out.append(issue("invalid_product_type", "tipo", F.col("tipo").isNotNull() & ~F.col("tipo").isin(*PRODUCT_TYPES)))
    if entity == "variantes" and "atributos" in columns:
        out.append(issue("invalid_attributes", "atributos", F.col("atributos").isNull() | (F.size("atributos") == 0)))
    for name in NON_NEGATIVE:
        if name in columns:
            out.append(issue("negative_value", name, F.col(name).try_cast("decimal(38,10)") < 0))
    return out


def validate(records: DataFrame, entity: str, row: str = "row_number", coercion: Column | None = None, text_comparison: bool = True) -> Validated:
    """Records with issues and warnings. The first row of an identity wins even if it is itself invalid.

    coercion: an array of issues from parsing, put first; such rows still take part in identities. With
    ``text_comparison``, precio_comparacion is text, as tables deliver it, and is not compared as a number.
    """
    columns = records.columns
    named = records.withColumn("_identity", identity(entity, columns))
    # only identities that repeat are joined back: few as a rule, and one row each however many records share one
    repeated = named.where("_identity is not null").groupBy(F.col("_identity").alias("_repeated")).agg(F.min(row).alias("_least"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = named.join(repeated, F.col("_identity") == F.col("_repeated"), "left")
    with_first = joined.withColumn("first_row", F.when(F.col("_identity").isNotNull(), F.coalesce("_least", row))).drop("_repeated", "_least")
    found = rules(entity, [c for c in columns if not (text_comparison and c == "precio_comparacion")])
    found.append(issue("duplicate_in_batch", None, F.col("first_row").isNotNull() & (F.col(row) > F.col("first_row"))))
    issues = F.array_compact(F.array(*found))
    if coercion is not None:
        issues = F.when(F.size(coercion) > 0, coercion).otherwise(issues)
    warnings = F.array().cast(f"array<{ISSUE}>")
    if not text_comparison and {"precio", "precio_comparacion"} <= set(columns):
        low = F.col("precio_comparacion").try_cast("decimal(38,10)") < F.col("precio")
        warnings = F.array_compact(F.array(issue("comparison_price_lower", "precio_comparacion", low, "warning")))
    return Validated(with_first.withColumn("issues", issues).withColumn("warnings", warnings).drop("_identity"))
