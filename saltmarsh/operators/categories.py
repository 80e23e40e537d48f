"""Categories and brands: ordered rules, references by containment, prefixes, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rule(key: Column, rules: list[tuple[str, str]]) -> Column:
    """The category of the first rule (text, category) whose text the key contains."""
    out = F.lit(None).cast("string")
    for text, category in reversed(rules):
        out = F.when(key.contains(text), category).otherwise(out)
    return out


def complete(key: Column, existing: Column, brand: Column, overrides: dict[str, str], rules: list[tuple[str, str]], brand_defaults: dict[str, str], default: str) -> Column:
    """struct(category, method): an override wins, then what is there, then rules, then defaults."""

    def lookup(c: Column, values: dict[str, str]) -> Column:
        out = F.lit(None).cast("string")
        for k, v in values.items():
            out = F.when(c == k, v).otherwise(out)
        return out

    steps = [("profile_override", lookup(key, overrides)), ("existing", F.nullif(F.trim(existing), F.lit(""))), ("profile_rule", first_rule(key, rules)), ("profile_default", F.coalesce(lookup(brand, brand_defaults), F.lit(default)))]
    method = F.coalesce(*[F.when(c.isNotNull(), F.lit(m)) for m, c in steps])
    return F.struct(F.coalesce(*[c for _, c in steps]).alias("category"), method.alias("method"))


#: References that are packed into one broadcast row; more of them meet the items by parts of their texts.
PACKED = 2_000


def by_reference(items: DataFrame, references: DataFrame, item: str = "name_key", packed: int = PACKED) -> DataFrame:
    """items with the category of the best reference (ref_key, category): equal scores 3, one inside the other 2.

    Several categories at the best score give none. The reference list is a profile: while it has few rows they are one
    broadcast row, an array. A longer list meets the distinct item texts by the first three characters of the shorter text,
    which stand somewhere in the longer one, so neither way pairs all rows.
    """
    refs = references.where(F.coalesce("ref_key", F.lit("")) != "").select("ref_key", "category").distinct()
    whole = items.where(F.col(item) != "")
    if refs.limit(packed + 1).count() <= packed:
        row = refs.agg(F.collect_set(F.struct("ref_key", "category")).alias("_refs"))
        scored = F.transform("_refs", lambda r: F.struct(F.when(r["ref_key"] == F.col(item), 3).when(F.col(item).contains(r["ref_key"]) | r["ref_key"].contains(F.col(item)), 2).otherwise(0).alias("score"), r["category"].alias("category")))
        joined = whole.join(F.broadcast(row)).withColumn("_scored", scored)
        best = F.array_max(F.transform("_scored", lambda s: s["score"]))
        top = F.array_distinct(F.transform(F.filter("_scored", lambda s: s["score"] == best), lambda s: s["category"]))
        return joined.withColumn("category_score", F.coalesce(best, F.lit(0))).withColumn("category", F.when((F.col("category_score") > 0) & (F.size(top) == 1), top[0])).drop("_refs", "_scored")
    texts = whole.select(F.col(item).alias("_t")).distinct()
    pairs = None
    for short, long in (("ref_key", "_t"), ("_t", "ref_key")):
        a, b = (refs, texts) if short == "ref_key" else (texts, refs)
        heads = a.withColumn("_g", F.substring(short, 1, 3))
        grams = b.withColumn("_g", F.explode(_grams(F.col(long))))
        met = heads.join(grams, "_g").where(F.col(long).contains(F.col(short))).select("_t", "ref_key", "category")
        pairs = met if pairs is None else pairs.unionByName(met)
    scores = pairs.select("_t", "category", F.when(F.col("_t") == F.col("ref_key"), 3).otherwise(2).alias("_s"))
    best = scores.groupBy("_t", "_s").agg(F.min("category").alias("_least"), F.max("category").alias("_most")).groupBy("_t").agg(F.max(F.struct("_s", "_least", "_most")).alias("_b"))
    chosen = best.select("_t", F.col("_b._s").alias("category_score"), F.when(F.col("_b._least") == F.col("_b._most"), F.col("_b._least")).alias("category"))
    return whole.join(chosen, F.col(item) == F.col("_t"), "left").withColumn("category_score", F.coalesce("category_score", F.lit(0))).drop("_t")


def _grams(c: Column) -> Column:
    """All parts of one to three characters (a text of fewer than three is looked for as a whole)."""
    n = F.char_length(c)

    def of(size: int) -> Column:
        return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substr(c, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of, (1, 2, 3))))


def brand_by_prefix(path: Column, prefixes: dict[str, list[str]], order: list[str], default: str) -> Column:
    """The first brand in order of which the path has a prefix."""
    out = F.lit(default)
    for brand in reversed(order):
        hit = F.lit(False)
        for p in prefixes.get(brand, []):
            hit = hit | F.lower(path).startswith(p.lower())
        out = F.when(hit, brand).otherwise(out)
    return out


def counts_with_zeros(rows: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """A count for every declared value, also for those without rows."""
    counted = rows.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    return declared.join(counted, F.col(key) == F.col("_k"), "left").select(key, F.coalesce("_n", F.lit(0)).alias("n"))
