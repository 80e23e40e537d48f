"""Whole flows over catalogue tables: a directory of documents, category pages, merges, variant prices, identifiers, review.

Every flow takes and returns DataFrames and only reads counts onto the driver; what a flow may not do (a repeated product, a
variant without a parent) is a row with a reason, and the caller decides whether any such row stops a run.

Defined cases: empty tables pass through; null names, pages and boxes take no part where the docstring does not say otherwise.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse, presentation, titles
from ..functions import text as fold
from ..schema import fields_for
from ..shared import stored
from . import align, blocks, cards, categories, prices, skus
from .validation import Validated, validate

# Headings of a category page, by their folded text, and lines of it that are no products.
CATEGORIES = {
    "geles corporales": "Geles corporales",
    "linea masajes": "Línea masajes",
    "oleos": "Óleos",
    "cremas corporales": "Cremas corporales",
    "emulsiones corporales": "Emulsiones corporales",
    "linea facial": "Línea facial",
    "linea para manos y pies": "Línea para manos y pies",
    "linea de booster": "Línea de booster",
}
SUBCATEGORIES = {"limpieza": "Limpieza", "lociones": "Lociones", "cremas": "Cremas", "mascaras": "Máscaras"}
PARENT_OF_SUBCATEGORIES = "Línea facial"
NO_PRODUCTS = ("indice", "tabla de contenido", "contenido")
# What a description's blocks hold besides copy, and where on a page copy stands.
BLOCK_HEADINGS = ("precio", "facial", "domiciliario", "peelingsquimicos", "lineacorporal")
COPY_TOP, COPY_BOTTOM = 130, 770
# Documents that a directory is searched for.
SUFFIXES = (".pdf", ".jpg", ".jpeg", ".png", ".webp", ".tif", ".tiff")


@dataclass(frozen=True)
class BatchRules:
    """Exceptions of a source: files, by name or relative path, that are category pages, left out, or read in their lower half."""

    source: str = ""
    category_files: tuple[str, ...] = ()
    keep_bottom_only: tuple[str, ...] = ()
    excluded_files: tuple[str, ...] = ()


def listed(path: Column, names: tuple[str, ...]) -> Column:
    """Whether a file is in a list, by its name or its path."""
    return path.isin(*names) | F.substring_index(path, "/", -1).isin(*names) if names else F.lit(False)


def role(path: Column, rules: BatchRules) -> Column:
    """What a file is for; a category page is one even if it is left out as well."""
    return F.when(listed(path, rules.category_files), "category_index").when(listed(path, rules.excluded_files), "excluded").otherwise("catalog_source")


def supported(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)).isin(*SUFFIXES)


def safe_name(path: Column) -> Column:
    """A file name that holds letters, digits, points, dashes and underscores only."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(path, "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", ""), F.lit("")), F.lit("source"))


def named(products: DataFrame, name: str = "nombre") -> DataFrame:
    """Products that have a name."""
    return products.where(F.coalesce(F.col(name), F.lit("")) != "")


def reorder_variants(df: DataFrame) -> DataFrame:
    """The import contract's variant columns first, others after them as they stand, without the cost."""
    known = [f.name for f in fields_for("variantes") if f.name in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known and c != "costo"])


def order_variants(df: DataFrame) -> DataFrame:
    """By parent, then own identifier, then attributes as text; missing ones first."""

    def said(c: str) -> Column:
        return F.coalesce(fold.canonical_json(F.col(c)) if dict(df.dtypes)[c].startswith("map") else F.col(c).cast("string"), F.lit(""))

    return df.orderBy(*[said(c) for c in ("sku_producto", "sku_variante", "atributos") if c in df.columns])


def block_noise(text: Column, top: Column) -> Column:
    """Whether a block of a sheet is no copy: nothing left of it, off the body of the page, a known heading, a pH, a bare currency."""

    def of(t: Column) -> Column:
        key = fold.match_key(t)
        bare = F.regexp_replace(F.regexp_replace(t, r"(?iU)\b(?:bs|b\.s\.)\b", ""), "^[ /.-]+|[ /.-]+$", "")
        return (t == "") | (top < COPY_TOP) | (top > COPY_BOTTOM) | key.isin(*BLOCK_HEADINGS) | key.startswith("ph") | (bare == "")

    return fold.let(presentation.clean_fragment(F.coalesce(text, F.lit(""))), of)


def category_entries(lines: DataFrame) -> DataFrame:
    """The products that a two-column category page lists, each under the last heading above it in its column.

    lines: source_file, page_number, width, block_id, text, x0, y0, and line_no if blocks have several. Subcategories count
    under one category only; elsewhere their words are products. A new category ends the subcategory before it.
    """
    order = ["y0", "block_id", *(c for c in ("line_no",) if c in lines.columns)]
    text = F.regexp_replace(fold.clean_text(F.col("text")), "^[ •\t-]+|[ •\t-]+$", "")
    rows = lines.withColumn("_text", text).where("_text <> ''").withColumn("_key", fold.fold_text(F.col("_text")))
    rows = rows.withColumn("_side", F.when(F.coalesce("x0", F.lit(0.0)) < F.col("width") / 2, 0).otherwise(1))

    def looked_up(values: dict[str, str]) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("_key"))

    so_far = Window.partitionBy("source_file", "page_number", "_side").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    place = F.row_number().over(Window.partitionBy("source_file", "page_number", "_side").orderBy(*order))
    rows = rows.withColumn("_at", place).withColumn("_head", looked_up(CATEGORIES))
    rows = rows.withColumn("_main", F.last("_head", ignorenulls=True).over(so_far)).withColumn("_main_at", F.max(F.when(F.col("_head").isNotNull(), F.col("_at"))).over(so_far))
    rows = rows.withColumn("_part", F.when(F.col("_head").isNull() & (F.col("_main") == PARENT_OF_SUBCATEGORIES), looked_up(SUBCATEGORIES)))
    last = F.max(F.when(F.col("_part").isNotNull(), F.struct("_at", "_part"))).over(so_far)
    rows = rows.withColumn("_sub", F.when(last["_at"] > F.col("_main_at"), last["_part"]))
    listed_ = F.col("_head").isNull() & F.col("_part").isNull() & F.col("_main").isNotNull() & ~F.col("_key").isin(*NO_PRODUCTS)
    entries = rows.where(listed_ & ~F.col("_text").rlike(r"^[0-9]+(?:\s*/\s*[0-9]+)?$") & F.char_length("_text").between(3, 120))
    return entries.select(F.concat_ws(" > ", "_main", "_sub").alias("categoria"), F.col("_text").alias("producto_referencia"), "source_file", "page_number", F.col("block_id").alias("source_block_id"))


@dataclass(frozen=True)
class Batch:
    """A directory's documents as tables: products and variants before and after validation, categories, files and issues."""

    products: Validated
    variants: Validated
    categories: DataFrame
    files: DataFrame
    unnamed: DataFrame
    without_cards: DataFrame

    def report(self, gate: bool = False) -> dict:
        """Counts, and whether the batch may be published: no failed file, no invalid row, no description that fails a gate."""
        files = self.files.agg(F.count("*").alias("source_count"), F.count_if(F.col("error").isNotNull()).alias("failed_source_count"), F.sum("pages").alias("total_pages")).first()
        p, v = self.products.report().first(), self.variants.report().first()
        status = F.col("status")
        told = self.products.rows.agg(*[F.count_if(status == s).alias(s) for s in ("pass", "reconstruct", "quarantine")], F.count_if(F.col("categoria").isNotNull()).alias("mapped"), F.count_if(F.col("descripcion").isNull()).alias("bare")).first()
        blocked = gate and told["reconstruct"] + told["quarantine"] > 0
        return {
            "source_count": files.source_count,
            "failed_source_count": files.failed_source_count,
            "total_pages": files.total_pages or 0,
            "total_cards": p.total_rows,
            "total_variant_candidates": v.total_rows,
            "valid_rows": p.valid_rows + v.valid_rows,
            "invalid_rows": p.invalid_rows + v.invalid_rows,
            "blocking_errors": p.blocking_errors + v.blocking_errors,
            "categories": {"entries_detected": self.categories.count(), "products_mapped": told.mapped},
            "descriptions": {"pass": told["pass"], "reconstruct": told.reconstruct, "quarantine": told.quarantine, "missing": told.bare, "blocked": blocked},
            "approved_for_publish": not files.failed_source_count and p.valid_rows > 0 and not p.invalid_rows and not v.invalid_rows and not blocked,
        }


def batch(block_rows: DataFrame, rules: BatchRules, errors: DataFrame | None = None, gap: float = cards.CARD_GAP, columns: int = 1, threshold: float = cards.CONFIDENCE, gate: bool = False) -> Batch:
    """All documents of a directory as one batch. block_rows: source_file, page_number, width, height, block_id, confidence, bbox, text.

    Files that are left out are not read; category pages give categories, the others cards. Of files read in their lower half,
    cards whose middle is above it go. Rows are numbered from 2 over all files in order of path. errors: (source_file, error)
    of files that could not be read.
    """
    known = block_rows.where("source_file is not null").withColumn("role", role(F.col("source_file"), rules))
    entries = category_entries(cards.lines_of(known.where("role = 'category_index'")))
    found = stored(cards.with_issues(cards.cards(cards.lines_of(known.where("role = 'catalog_source'")), gap, columns), threshold, gate=gate), "batch-cards")
    lower = listed(F.col("source_file"), rules.keep_bottom_only)
    heights = block_rows.where(lower).groupBy("source_file", "page_number").agg(F.max("height").alias("height"))
    low = blocks.keep_below_middle(found.where(lower).join(heights, ["source_file", "page_number"], "left"))
    kept = low.unionByName(found.where(~lower), allowMissingColumns=True).drop("height")
    kept = kept.withColumn("_place", F.struct("page_number", "card"))
    numbered = align.rebased(kept, "source_file", "_place").drop("_place")
    whole = named(numbered, "name")
    categorised = categories.by_reference(whole.withColumn("name_key", fold.fold_text(F.col("name"))), entries.select(fold.fold_text(F.col("producto_referencia")).alias("ref_key"), F.col("categoria").alias("category")))
    product_rows = categorised.select("row_number", "sku", F.col("name").alias("nombre"), F.col("description").alias("descripcion"), F.col("category").alias("categoria"), F.col("kind").alias("tipo"), F.col("attributes").alias("atributos"), *[parse.table_number(F.col(c)).alias(n) for c, n in (("price", "precio"), ("stock", "stock"))], F.transform("issues", lambda i: F.struct(i.alias("code"), F.lit(None).cast("string").alias("field"), F.lit("error").alias("severity"))).alias("coercion"), "status", "source_file", "page_number", "block_ids", "name_evidence", "description_evidence")
    variant_rows = align.rebased(cards.variants(kept).withColumn("_place", F.struct("page_number", "row_number")), "source_file", "_place", "row").drop("_place", "row_number").withColumnRenamed("row", "row_number")
    files = known.groupBy("source_file", "role").agg(F.count_distinct("page_number").alias("pages"), F.count("*").alias("blocks"))
    counts = kept.groupBy("source_file").agg(F.count("*").alias("products"), F.sum(F.size("variants")).alias("variants"))
    # a row a file on either side: the estimate of a compressed table's size would have the driver collect one
    files = files.join(counts.hint("merge"), "source_file", "left").na.fill(0, ["products", "variants"])
    if errors is None:
        files = files.withColumn("error", F.lit(None).cast("string"))
    else:
        files = files.join(errors, "source_file", "full").na.fill(0, ["pages", "blocks", "products", "variants"]).withColumn("role", F.coalesce("role", role(F.col("source_file"), rules)))
    return Batch(
        validate(product_rows, "productos", coercion=F.col("coercion")),
        validate(variant_rows, "variantes"),
        entries,
        files,
        numbered.where(F.coalesce("name", F.lit("")) == "").select("source_file", "page_number", "row_number", "text"),
        cards.nothing_found(known.where("role = 'catalog_source'"), found),
    )


# ---- merging reviewed products into a catalogue


def merge_catalog(products: DataFrame, variants: DataFrame, reviewed: DataFrame, brand: str, brand_order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, variants, refused): a catalogue with reviewed products of one brand added.

    reviewed: page, name, description, category, presentations array<struct<presentation, price>>. A product's price is its
    least presentation price until variants are enriched; several presentations make it variable; cost is never inferred. A
    name that the brand has already, in the catalogue or twice among the reviewed, is refused. Products are ordered by rank
    of brand and name key through ``_pos``.
    """
    key = fold.match_key(F.col("nombre"))
    fresh = reviewed.withColumn("nombre", titles.title_case(F.col("name"))).withColumn("_key", key).withColumn("marca", F.lit(brand))
    have = products.select(F.col("marca").alias("_b"), key.alias("_k")).distinct()
    first = F.row_number().over(Window.partitionBy("_key").orderBy("page", "name"))
    judged = fresh.join(have, (F.col("marca") == F.col("_b")) & (F.col("_key") == F.col("_k")), "left").withColumn("reason", F.when(F.col("_k").isNotNull(), "product_exists").when(first > 1, "repeated_in_review"))
    added = judged.where("reason is null")
    rows = added.select(
        "nombre",
        titles.format_description(F.coalesce("description", F.lit(""))).alias("descripcion"),
        F.col("category").alias("categoria"),
        "marca",
        F.when(F.size("presentations") > 1, "variable").otherwise("simple").alias("tipo"),
        parse.number_text(F.array_min(F.transform("presentations", lambda p: p["price"]))).alias("precio"),
    )
    merged = align.append(products, rows.select(*[c for c in rows.columns if c in products.columns]))
    ranked = merged.withColumn("brand", F.col("marca")).withColumn("name_key", key)
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(b) for b in brand_order]), F.col("marca")), F.lit(0)), F.lit(len(brand_order) + 1))
    out = ranked.withColumn("brand_rank", rank).drop("brand")
    one = added.select(F.explode("presentations").alias("_p"))
    more = one.select(F.create_map(F.lit("presentacion"), F.col("_p.presentation")).alias("atributos"), parse.number_text(F.col("_p.price")).alias("precio"))
    return out, align.append(variants, more.select(*[c for c in more.columns if c in variants.columns])), judged.where("reason is not null").select("page", "name", "reason")


# ---- prices of variants


@dataclass(frozen=True)
class VariantPrices:
    """Variants and products with the prices of a list, the rows that found no place, and what contradicts present values."""

    variants: DataFrame
    products: DataFrame
    unmatched: DataFrame
    conflicts: DataFrame
    problems: DataFrame = field(default=None)


def enrich_variants(products: DataFrame, variants: DataFrame, price_rows: DataFrame) -> VariantPrices:
    """Prices to variants by presentation, and the least of them to their products.

    products (sku, precio, costo), variants (sku_producto, sku_variante, atributos, precio, costo), price_rows (price_id,
    target: a product's sku, raw_name, price, cost, source_row), with values as text in products and variants. A present
    value that differs as text, or two values for one variant, is a conflict. Only variants priced here roll up; a product
    without variants takes the least price itself.
    """
    shown = variants.where(F.trim(F.coalesce("sku_producto", F.lit(""))) != "").select("sku_producto", "sku_variante", presentation.from_attributes(F.col("atributos")).alias("presentation"))
    matched = prices.match_presentations(price_rows, shown)
    found = matched.where(F.col("sku_variante").isNotNull())
    values = found.select("sku_variante", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), parse.number_text(F.col(c)).alias("value")) for n, c in (("precio", "price"), ("costo", "cost"))])).alias("v")).select("sku_variante", "v.*").where("value is not null")
    given = values.groupBy("sku_variante", "field").agg(F.min("value").alias("value"), F.count_distinct("value").alias("n"))
    now = variants.select(F.col("sku_variante").alias("_s"), F.explode(F.array(*[F.struct(F.lit(n).alias("_f"), F.trim(F.coalesce(n, F.lit(""))).alias("existing")) for n in ("precio", "costo")])).alias("_e")).select("_s", "_e.*")
    beside = given.join(now, (F.col("sku_variante") == F.col("_s")) & (F.col("field") == F.col("_f")))
    conflicts = beside.where((F.col("n") > 1) | ((F.col("existing") != "") & (F.col("existing") != F.col("value")))).select(F.col("sku_variante").alias("sku"), "field", "existing", F.col("value").alias("incoming"))
    wide = given.groupBy(F.col("sku_variante").alias("_s")).agg(*[F.max(F.when(F.col("field") == n, F.col("value"))).alias(f"_{n}") for n in ("precio", "costo")])
    priced = variants.join(wide, F.col("sku_variante") == F.col("_s"), "left")
    out = priced.select(*[F.coalesce(f"_{c}", c).alias(c) if c in ("precio", "costo") else F.col(c) for c in variants.columns])
    numeric = [parse.table_number(F.col(c)) for c in ("precio", "costo")]
    rolled = priced.where(F.col("_s").isNotNull()).select("sku_producto", *[F.coalesce(f"_{c}", c).alias(c) for c in ("precio", "costo")]).groupBy(F.col("sku_producto").alias("_p")).agg(*[parse.number_text(F.min(n)).alias(f"_{c}") for n, c in zip(numeric, ("precio", "costo"))])
    alone = prices.product_only_rollup(matched).select(F.col("sku").alias("_p"), parse.number_text(F.col("price")).alias("_precio"), parse.number_text(F.col("cost")).alias("_costo"))
    clash = alone.join(products, F.col("_p") == F.col("sku")).select("sku", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.trim(F.coalesce(c, F.lit(""))).alias("existing"), F.col(f"_{c}").alias("incoming")) for c in ("precio", "costo")])).alias("e")).select("sku", "e.*").where("incoming is not null and existing <> '' and existing <> incoming")
    new = rolled.unionByName(alone)
    told = products.join(new, F.col("sku") == F.col("_p"), "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in ("precio", "costo") else F.col(c) for c in products.columns])
    return VariantPrices(order_variants(out), told, matched.where(F.col("reason").isNotNull() & (F.col("reason") != prices.RETAINED)), conflicts.unionByName(clash), variant_problems(products, out))


def variant_problems(products: DataFrame, variants: DataFrame) -> DataFrame:
    """(problem, n): products and variants without an identifier, variants without a known parent, repeated combinations."""

    def blank(c: str) -> Column:
        return F.trim(F.coalesce(c, F.lit(""))) == ""

    parts = {
        "missing_product_sku": products.where(blank("sku")),
        "missing_variant_parent": variants.where(blank("sku_producto")),
        "unknown_variant_parent": align.orphans(variants.where(~blank("sku_producto")), products, "sku_producto", "sku"),
        "missing_variant_sku": variants.where(blank("sku_variante")),
        "duplicate_combination": variants.groupBy("sku_producto", fold.canonical_json(F.col("atributos")).alias("a")).count().where("count > 1").select(F.explode(F.sequence(F.lit(2), F.col("count").cast("int"))).alias("again")),
    }
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# ---- identifiers end to end


def link_variants(variants: DataFrame, products: DataFrame) -> DataFrame:
    """variants with ``parent``, the sku of the one product of their file and name, or else of their file and page; null if there is none.

    products: sku, source_file, name_key, page_number; variants: source_file, name_key, page_number and more.
    """

    def single(key: str, out: str) -> DataFrame:
        some = products.where(F.col("source_file").isNotNull() & F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
        return some.groupBy(F.col("source_file").alias(f"_{out}f"), F.col(key).alias(f"_{out}k")).agg(F.count("*").alias("_n"), F.min("sku").alias(out)).where("_n = 1").drop("_n")

    joined = variants
    for key, out in (("name_key", "_byname"), ("page_number", "_bypage")):
        joined = joined.join(single(key, out), (F.col("source_file") == F.col(f"_{out}f")) & (F.col(key) == F.col(f"_{out}k")), "left").drop(f"_{out}f", f"_{out}k")
    return joined.withColumn("parent", F.coalesce("_byname", "_bypage")).drop("_byname", "_bypage")


@dataclass(frozen=True)
class Assigned:
    """Products and variants with identifiers, both states grown, and the rows that stop a run with their reasons."""

    products: DataFrame
    variants: DataFrame
    product_state: DataFrame
    variant_state: DataFrame
    conflicts: DataFrame


def assign_skus(products: DataFrame, variants: DataFrame, prefixes: dict[str, str], product_state: DataFrame, variant_state: DataFrame) -> Assigned:
    """Identifiers of products by their brand's counter, of variants by their product's; products that get variants become variable.

    products: _pos, sku, nombre, marca, tipo, identity_key, source_file, page_number; variants: _pos, sku_variante, atributos,
    identity_rest (what tells variants of a product apart), source_file, page_number, nombre. States: identity_key, sku.
    """
    prefix = F.try_element_at(F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair]), F.trim("marca")) if prefixes else F.lit(None).cast("string")
    known = products.withColumn("prefix", prefix)
    with_sku, grown = skus.assign(known.where(F.col("prefix").isNotNull()), product_state)
    keyed = with_sku.withColumn("name_key", fold.match_key(F.col("nombre")))
    linked = link_variants(variants.withColumn("name_key", fold.match_key(F.col("nombre"))), keyed.where("conflict is null").select("sku", "source_file", "name_key", "page_number"))
    of_parent = keyed.where("conflict is null").select(F.col("sku").alias("_s"), F.col("identity_key").alias("_pk"), F.coalesce("tipo", F.lit("simple")).alias("_tipo"))
    homed = linked.where("parent is not null").join(of_parent, F.col("parent") == F.col("_s"))
    ready = homed.where(F.col("_tipo").isin("simple", "variable")).select("_pos", F.col("parent").alias("prefix"), F.col("sku_variante").alias("sku"), F.concat_ws("|", "_pk", "identity_rest").alias("identity_key"), "atributos")
    variants_with, variants_grown = skus.assign(ready, variant_state, variant=True)
    having = ready.select(F.col("prefix").alias("_v")).distinct()
    kind = F.coalesce("tipo", F.lit("simple"))
    final = with_sku.join(having, F.col("sku") == F.col("_v"), "left").withColumn("promoted", F.col("_v").isNotNull() & (kind == "simple")).withColumn("tipo", F.when(F.col("_v").isNotNull() & (kind == "simple"), "variable").otherwise(F.col("tipo"))).withColumn("_bare", F.col("_v").isNull() & (kind == "variable"))

    def refused(df: DataFrame, entity: str, reason: Column) -> DataFrame:
        return df.select(F.lit(entity).alias("entity"), "_pos", reason.alias("reason")).where("reason is not null")

    conflicts = [
        refused(known.where(F.col("prefix").isNull()), "productos", F.lit("no_prefix_for_brand")),
        refused(with_sku, "productos", F.coalesce("conflict", F.when(~skus.well_formed(F.col("sku")) | ~F.col("sku").startswith(F.concat("prefix", F.lit("-"))), "malformed_sku"))),
        refused(final.where("_bare"), "productos", F.lit("variable_without_variant")),
        refused(linked.where("parent is null"), "variantes", F.lit("no_single_product")),
        refused(homed.where(~F.col("_tipo").isin("simple", "variable")), "variantes", F.lit("product_not_variable")),
        refused(variants_with, "variantes", F.coalesce("conflict", F.when(~skus.well_formed(F.col("sku"), variant=True) | ~F.col("sku").startswith(F.concat("prefix", F.lit("-V"))), "malformed_sku"))),
    ]
    all_conflicts = conflicts[0]
    for c in conflicts[1:]:
        all_conflicts = all_conflicts.unionByName(c)
    told = variants_with.select("_pos", F.col("prefix").alias("sku_producto"), F.col("sku").alias("sku_variante"), "atributos")
    return Assigned(final.drop("_v", "_bare", "prefix"), order_variants(told), grown, variants_grown, all_conflicts)


# ---- review


def review(products: DataFrame, quality_rows: DataFrame) -> DataFrame:
    """Products beside the quality of their descriptions, by row number, in order of brand and name; unknown ones are not assessed."""
    told = quality_rows.select(F.col("row_number").alias("_row"), "status", F.array_join("flags", ", ").alias("flags"))
    joined = products.join(told, F.col("row_number") == F.col("_row"), "left")
    shown = joined.select("row_number", *[F.coalesce(c, F.lit("")).alias(c) for c in ("marca", "nombre", "descripcion")], F.coalesce("status", F.lit("sin_evaluar")).alias("status"), F.coalesce("flags", F.lit("")).alias("flags"))
    return shown.orderBy(fold.casefold(F.col("marca")), fold.casefold(F.col("nombre")), "row_number")


def profile_json(value: object) -> str:
    """What was configured, as stable JSON for a run's records."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2, default=lambda o: o.__dict__)
