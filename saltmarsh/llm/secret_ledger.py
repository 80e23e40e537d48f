"""Secret scans over an incremental blob ledger. DataFrame functions only.

Every text is addressed by the SHA-256 of its content. A ledger row records, for one blob, which rule versions have
been run over it and what they found. A scan reads only pairs of blob and rule version that the ledger has not seen,
whichever paths or historical versions of them hold the blob, and findings are joined back to all of those.

Scale: one shuffle of the distinct texts (copies are folded map-side first) and one of narrow (path, blob) rows; the
ledger is a Parquet table, so that join's two sides are plain exchanges and a blob of many copies can be split.

Findings carry the version of their rule: a ledger keeps what older versions found, and a scan reports the versions it was
asked for only.

Defined cases: null text is empty; null paths and repeated rows are kept, each with its findings; an empty table gives
no rows; other columns of the input are carried only where the docstring says so, whatever their names; two scans that
add the same pair at once do no harm, as findings are sets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, private, shared_dir, stored


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are found leftmost and non-overlapping; a match counts if a group has enough characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def tag(self) -> str:
        return f"{self.name}@{self.version}"


def either_case(word: str) -> str:
    """A pattern for the word's letters in either case, ASCII only."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The base rules. Runs of one class are maximal, so their least length can stand in the pattern; a failing
#: assignment consumes its text and so is matched first and dropped after.
BASE = (Rule("assign", ASSIGN, 2, 8), Rule("access", "AKIA[A-Z0-9]{12,}"), Rule("hex", "[0-9a-f]{32,}"))
#: Found besides: headers of private keys.
MORE = (Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),)
RULES = BASE + MORE
#: After that header: fields such as Proc-Type, then all up to the END line, or without one the lines of base64.
_FIELDS = r"(?:\s*+[A-Za-z][A-Za-z0-9-]*+:\x20[^\n]*+){0,8}+"
_LINES = r"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{16,}+={0,2}+){1,1000}+(?:\s*?\n[A-Za-z0-9+/]++={0,2}+(?=[\r\x20]*+(?:\n|\z)))?"
#: What is masked: as RULES, but a private key whole.
MASKED = BASE + (Rule("pem", rf"{MORE[0].pattern}(?:{_FIELDS}(?:[^-]*+-----END [A-Z ]*PRIVATE KEY-----|{_LINES}))?", version=2),)

FINDINGS = "array<struct<start:int,rank:int,end:int,kind:string,rule:string>>"
LEDGER = f"blob_id string, rule_versions array<string>, findings {FINDINGS}"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Findings of one rule: struct(start, rank, end, kind, rule at its version) in code points, end exclusive.

    The text between matches and the matches themselves give every position by running sums.
    """
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.char_length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.char_length) if rule.group else hits
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("size"), counted.alias("counted"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FINDINGS).alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["size"]
        one = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.name).alias("kind"), F.lit(rule.tag).alias("rule"))).cast(FINDINGS)
        return F.struct(end.alias("at"), F.when(x["counted"] >= rule.least, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    found = F.aggregate(steps, start, step, lambda s: s["found"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(FINDINGS))


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """New ledger rows (blob_id, rule_versions, findings) for pairs of blob and rule version that the ledger lacks."""
    tags = F.array(*(F.lit(r.tag) for r in rules))
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = docs.select(blob_id(F.col(text)).alias("blob_id"), body.alias("body")).groupBy("blob_id").agg(F.first("body").alias("body"))
    if ledger is None:
        blobs = blobs.withColumn("rule_versions", tags)
    else:
        seen = ledger.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("rule_versions"))).alias("seen"))
        blobs = blobs.join(seen, "blob_id", "left").withColumn("rule_versions", F.array_except(tags, F.coalesce("seen", F.array().cast("array<string>"))))
        blobs = blobs.where(F.size("rule_versions") > 0)
    none = F.array().cast(FINDINGS)
    each = [F.when(F.array_contains("rule_versions", r.tag), matches(F.col("body"), r, i)).otherwise(none) for i, r in enumerate(rules)]
    return blobs.select("blob_id", "rule_versions", F.array_sort(F.concat(*each)).alias("findings"))


class Ledger:
    """The ledger as a Parquet table at a path of its own; by default a new one in the shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or f"{shared_dir(spark)}/saltmarsh/secret-ledger-{uuid.uuid4().hex}"

    def rows(self) -> DataFrame | None:
        """(blob_id, rule_versions, findings) of all scans so far; None before the first."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)
        return self.spark.read.schema(LEDGER).parquet(self.path) if there else None

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
        """Scan the pairs of blob and rule version that are new in docs, and add them."""
        scan_unseen(docs, self.rows(), rules, text).write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob_id, findings) of the blobs where these versions of the rules have found something."""
        rank = {r.tag: i for i, r in enumerate(rules)}
        ranks = F.create_map(*[F.lit(x) for tag, i in rank.items() for x in (tag, i)])
        current = F.filter(F.flatten(F.collect_list("findings")), lambda x: x["rule"].isin(list(rank)))
        ranked = F.transform(current, lambda x: x.withField("rank", F.coalesce(ranks[x["rule"]], F.lit(0))))  # places may differ between scans
        found = self.rows().where(F.size("findings") > 0).groupBy("blob_id").agg(F.array_sort(F.array_distinct(ranked)).alias("findings"))
        return found.where(F.size("findings") > 0)


def history(docs: DataFrame, doc_id: str = "doc_id") -> list[DataFrame]:
    """A table that grew by ascending id, as it stood half way and as it stands now: all rows."""
    half = docs.agg(((F.min(doc_id) + F.max(doc_id)) / 2).alias("half")).first().half
    return [docs] if half is None else [docs.where(F.col(doc_id) <= half), docs]


def scan_secrets(versions: DataFrame | list[DataFrame], ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row's ``keep`` columns with all findings of its blob, as column ``findings``, of the last of some versions of a table.

    The versions are scanned one after another, each for what the ledger has not seen yet.
    """
    versions = versions if isinstance(versions, list) else [versions]
    docs = versions[-1]
    ledger = ledger or Ledger(docs.sparkSession)
    for v in versions:
        ledger.scan(v, rules, text)
    blob, key, found = private(docs, "_blob", "_key", "_found")
    paths = docs.select(*[F.col(c) for c in keep], blob_id(F.col(text)).alias(blob))
    joined = paths.join(ledger.findings(rules).toDF(key, found), F.col(blob) == F.col(key), "left")
    return joined.select(*keep, F.coalesce(found, F.array().cast(FINDINGS)).alias("findings"))


def span_digests(paths: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts by base rule, the digest of the base spans, and all spans as text."""

    def said(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    names = [r.name for r in base]
    kinds = F.transform("findings", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{n}") for n in names]
    based = F.filter("findings", lambda x: x["kind"].isin(names))
    return paths.select("doc_id", *counts, F.sha2(said(based), 256).alias("base_sha256"), said(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = MASKED, text: str = "text", mask: str = "[secret]", doc_id: str = "doc_id", ledger: Ledger | None = None) -> DataFrame:
    """docs with every found span replaced by the mask (overlapping spans by one); n_chars follows where there is such a column."""
    columns, ledger = docs.columns, ledger or Ledger(docs.sparkSession)
    blob, key, found = private(docs, "_blob", "_key", "_found")
    for v in history(docs, doc_id):
        ledger.scan(v, rules, text)
    hit = stored(ledger.findings(rules).toDF(key, found), "secret-redact")
    # few findings in all are broadcast, so that the texts stay where they are
    few = hit.select(F.explode(found)).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = docs.withColumn(blob, blob_id(F.col(text))).join(F.broadcast(hit) if few else hit, F.col(blob) == F.col(key), "left")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, x: Column) -> Column:
        apart = x["start"] >= s["at"]
        piece = F.array(F.substr(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.lit(mask))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(apart, F.concat(s["parts"], piece)).otherwise(s["parts"]).alias("parts"))

    clean = F.aggregate(found, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(F.col(text), s["at"] + 1)))
    out = joined.withColumn(text, F.when(F.col(found).isNotNull(), clean).otherwise(F.col(text)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col(found).isNotNull(), F.char_length(F.col(text)).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*columns)
