"""Stable identifiers: identity keys, a persistent map, and numbers that fill gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_json, match_key, stable_text


def product_identity(file: Column, page: Column, name: Column, bbox: Column, row: Column, brand: Column) -> Column:
    """File, page, name and box if all are known; else file, row and name; else brand and name."""
    key = match_key(name)
    return F.coalesce(
        F.when(file.isNotNull() & page.isNotNull() & bbox.isNotNull(), F.concat_ws("|", stable_text(file), page.cast("string"), key, bbox)),
        F.when(file.isNotNull() & row.isNotNull(), F.concat_ws("|", stable_text(file), row.cast("string"), key)),
        F.concat_ws("|", match_key(brand), key),
    )


def variant_identity(product: Column, file: Column, page: Column, row: Column, attributes: Column) -> Column:
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in (product, stable_text(file), page, row)]
    return F.concat_ws("|", *text, canonical_json(attributes))


def allocate(needers: DataFrame, used: DataFrame, group: str, order: str) -> DataFrame:
    """needers with ``number``: in each group the n-th needer takes the n-th number from 1 up that used (group, number) lacks.

    The free numbers come from the gaps between used ones, so no sequence longer than the gaps is built: a needer's number
    is its rank plus the used numbers that lie below it.
    """
    ranked = needers.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    taken = used.where(F.col("number") >= 1).select(F.col(group).alias("_g"), F.col("number").alias("_u")).distinct()
    # before the i-th used number u there are u - i free ones: a rank above that passes it
    numbered = taken.withColumn("_i", F.row_number().over(Window.partitionBy("_g").orderBy("_u"))).withColumn("_free", F.col("_u") - F.col("_i"))
    steps = numbered.groupBy("_g", "_free").agg(F.max("_i").alias("_passed"))
    events = ranked.select(F.col(group).alias("_g"), F.col("_rank").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_passed")).unionByName(steps.select("_g", (F.col("_free") + 1).alias("_at"), F.lit(0).alias("_kind"), F.col("_passed")))
    passed = F.coalesce(F.max("_passed").over(Window.partitionBy("_g").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    found = events.withColumn("_p", passed).where("_kind = 1").select(F.col("_g").alias("_g2"), F.col("_at").alias("_rank2"), "_p")
    out = ranked.join(found, (F.col(group) == F.col("_g2")) & (F.col("_rank") == F.col("_rank2")))
    return out.withColumn("number", (F.col("_rank") + F.col("_p")).cast("int")).drop("_g2", "_rank2", "_p", "_rank")


def product_sku(prefix: Column, number: Column) -> Column:
    return F.format_string("%s-%04d", prefix, number)


def variant_sku(product: Column, number: Column) -> Column:
    return F.format_string("%s-V%02d", product, number)


def well_formed(sku: Column, variant: bool = False) -> Column:
    return sku.rlike(r"^[A-Z0-9]+-[0-9]{4}-V[0-9]{2}$" if variant else r"^[A-Z0-9]+-[0-9]{4}$")


def assign(rows: DataFrame, state: DataFrame, variant: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with sku, state grown): rows (identity_key, prefix, _pos, sku or null); state (identity_key, sku).

    The prefix is a brand's, or for variants their product's sku. A known identity keeps its SKU; a present SKU that the
    state contradicts, a repeated identity, or a repeated SKU, is an error row in ``conflict``. Only the state's numbers count as used.
    """
    known = rows.join(state.select(F.col("identity_key").alias("_ik"), F.col("sku").alias("_known")), F.col("identity_key") == F.col("_ik"), "left").drop("_ik")
    repeated = F.count("*").over(Window.partitionBy("identity_key")) > 1
    present = F.nullif(F.trim("sku"), F.lit(""))
    conflict = F.when(repeated, "repeated_identity").when(present.isNotNull() & F.col("_known").isNotNull() & (present != F.col("_known")), "sku_contradicts_state")
    known = known.withColumn("conflict", conflict).withColumn("_have", F.coalesce("_known", present))
    head, tail = ("^(.+)-V[0-9]{2}$", "-V([0-9]{2})$") if variant else ("^([A-Z0-9]+)-[0-9]{4}$", "-([0-9]{4})$")
    used = state.select(F.regexp_extract("sku", head, 1).alias("prefix"), F.regexp_extract("sku", tail, 1).try_cast("int").alias("number")).where("number is not null")
    named = variant_sku if variant else product_sku
    fresh = allocate(known.where("_have is null"), used, "prefix", "_pos").withColumn("_have", named(F.col("prefix"), F.col("number"))).drop("number")
    done = known.where("_have is not null").unionByName(fresh).withColumn("sku", F.col("_have")).drop("_have", "_known")
    again = F.count("*").over(Window.partitionBy("sku")) > 1
    done = done.withColumn("conflict", F.coalesce("conflict", F.when(again, "repeated_sku")))
    grown = state.select("identity_key", "sku").unionByName(done.where("conflict is null").select("identity_key", "sku")).distinct()
    return done, grown
