"""Price enrichment: joins that never guess. Every price row ends in a match or in a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import presentation

NO_RECORD, NOT_UNIQUE = "no_alias_or_catalog_record", "catalog_target_not_unique_or_missing"
RETAINED = "no_variant_row_product_price_retained"
AMBIGUOUS, NOT_FOUND = "variant_presentation_missing_or_ambiguous", "variant_presentation_not_found_or_ambiguous"


def resolve_alias(prices: DataFrame, aliases: DataFrame) -> DataFrame:
    """prices (brand, name_key, ...) with the catalogue key that aliases (brand, alias_key, catalog_key) gives, else its own."""
    found = aliases.select(F.col("brand").alias("_b"), F.col("alias_key").alias("_k"), F.col("catalog_key").alias("_target"))
    return prices.join(found, (F.col("brand") == F.col("_b")) & (F.col("name_key") == F.col("_k")), "left").withColumn("target_key", F.coalesce("_target", "name_key")).withColumn("by_alias", F.col("_target").isNotNull()).drop("_b", "_k", "_target")


def unique_target(prices: DataFrame, products: DataFrame, price_id: str = "price_id") -> DataFrame:
    """prices (price_id, target_key, brand) with target (a product's sku) and reason.

    One product of the key is taken whatever its brand; of several, the one of the row's brand, if it is one. Products are
    counted per key and per key and brand before anything is joined, so a name that very many products share costs one row.
    """
    by_key = products.groupBy("name_key").agg(F.count("*").alias("_n"), F.min("sku").alias("_only"))
    by_brand = products.groupBy("name_key", "brand").agg(F.count("*").alias("_nb"), F.min("sku").alias("_mine"))
    key = by_key.withColumnRenamed("name_key", "_key")
    brand = by_brand.select(F.col("name_key").alias("_key2"), F.col("brand").alias("_brand2"), "_nb", "_mine")
    joined = prices.join(key, F.col("target_key") == F.col("_key"), "left").join(brand, (F.col("target_key") == F.col("_key2")) & (prices["brand"] == F.col("_brand2")), "left")
    target = F.when(F.col("_n") == 1, F.col("_only")).when(F.col("_nb") == 1, F.col("_mine"))
    reason = F.when(target.isNotNull(), F.lit(None).cast("string")).when(F.col("_n").isNull(), NO_RECORD).otherwise(NOT_UNIQUE)
    return joined.select(*[prices[c] for c in prices.columns], target.alias("target"), reason.alias("reason"))


def least_prices(matched: DataFrame, key: str = "target") -> DataFrame:
    """Least price and cost of each target, nulls ignored, and how many rows they come from."""
    kind = F.when(F.count("*") == 1, "direct").otherwise("minimum_until_variants_pass")
    return matched.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("price").alias("price"), F.min("cost").alias("cost"), F.count("*").alias("n_rows"), kind.alias("price_source"))


def enrich_products(products: DataFrame, matched: DataFrame) -> DataFrame:
    """Products whose price and cost are those of matched rows only: what they held before goes."""
    least = least_prices(matched).select(F.col("target").alias("_t"), F.col("price").alias("precio"), F.col("cost").alias("costo"), "price_source")
    kept = [c for c in products.columns if c not in ("precio", "costo")]
    return products.select(*kept).join(least, products["sku"] == F.col("_t"), "left").drop("_t")


def match_presentations(prices: DataFrame, variants: DataFrame) -> DataFrame:
    """prices (price_id, target, raw_name, price, cost) with the variant each goes to, or a reason.

    A product without variants keeps the price itself; one variant takes it; of several, the one of the same presentation,
    if it is one. variants: sku_producto, sku_variante, presentation.
    """
    p = prices.withColumn("_sig", presentation.signature(F.col("raw_name")))
    v = variants.withColumn("_vsig", presentation.signature(F.col("presentation")))
    sizes = v.groupBy(F.col("sku_producto").alias("_p0")).agg(F.count("*").alias("_variants"), F.min("sku_variante").alias("_single"))
    # variants are counted by size before anything is joined: a size that very many of a product's variants share is one row
    by_unit = v.where(F.col("_vsig").isNotNull()).groupBy(F.col("sku_producto").alias("_p1"), F.col("_vsig.quantity").alias("_q"), F.col("_vsig.unit").alias("_u")).agg(F.count("*").alias("n"), F.min("sku_variante").alias("first"))
    of_size = by_unit.groupBy("_p1", "_q").agg(F.collect_list(F.struct("_u", "n", "first")).alias("_units"))
    joined = p.join(sizes, F.col("target") == F.col("_p0"), "left").join(of_size, (F.col("target") == F.col("_p1")) & (F.col("_sig.quantity") == F.col("_q")), "left")
    met = F.filter("_units", lambda x: presentation.same_unit(F.col("_sig.unit"), x["_u"]))
    joined = joined.withColumn("_met", met).withColumn("_hits", F.aggregate("_met", F.lit(0).cast("long"), lambda n, x: n + x["n"])).withColumn("_hit", F.array_min(F.transform("_met", lambda x: x["first"])))
    variant = F.when(F.col("_variants") == 1, F.col("_single")).when(F.col("_hits") == 1, F.col("_hit"))
    reason = F.when(F.col("_variants").isNull(), RETAINED).when(variant.isNotNull(), F.lit(None).cast("string")).when(F.col("_sig").isNull(), AMBIGUOUS).otherwise(NOT_FOUND)
    return joined.select(*prices.columns, variant.alias("sku_variante"), reason.alias("reason"))


def parent_rollup(assigned: DataFrame) -> DataFrame:
    """Least price and cost over the variants that got a price in this run."""
    return assigned.where(F.col("sku_variante").isNotNull()).groupBy(F.col("target").alias("sku_producto")).agg(F.min("price").alias("price"), F.min("cost").alias("cost"), F.count_distinct("sku_variante").alias("n_variants"))


def product_only_rollup(retained: DataFrame) -> DataFrame:
    """Least price and cost with the rows that gave a value, for products without variants."""

    def rows(value: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.col("source_row"))))

    return retained.where(F.col("reason") == RETAINED).groupBy(F.col("target").alias("sku")).agg(F.min("price").alias("price"), F.min("cost").alias("cost"), rows("price").alias("price_rows"), rows("cost").alias("cost_rows"))


def text_conflicts(existing: DataFrame, incoming: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose present value differs, as text, from the one to write: any such row stops a run."""
    new = incoming.select(F.col(key).alias("_k"), F.col(value).alias("incoming"))
    return existing.join(new, F.col(key) == F.col("_k")).where((F.trim(value) != "") & (F.col(value) != F.col("incoming"))).select(key, F.col(value).alias("existing"), "incoming")


def unmatched(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull())


def order_products(products: DataFrame, brand_order: list[str]) -> DataFrame:
    """By rank of brand (unknown ones last), then name key, then position."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(b) for b in brand_order]), F.col("brand")), F.lit(0)), F.lit(len(brand_order) + 1))
    return products.withColumn("brand_rank", rank).orderBy("brand_rank", "name_key", "_pos")
