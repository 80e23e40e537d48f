"""Command line: preview, validate, inspect, approve and publish runs; directories of documents; variant prices; review pages."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import runs, sinks
from .config import batch_rules, mapping_profile
from .functions import parse
from .operators import flows, quality
from .operators.mapping import preview
from .schema import fields_for
from .sources.documents import failures, read_documents
from .sources.remote import ImportService
from .sources.tables import read_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="saltmarsh")
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str, **options: dict) -> None:
        c = commands.add_parser(name)
        for f in flags:
            c.add_argument(f, **options.get(f.lstrip("-").replace("-", "_"), {}))

    table = {"entity": {"default": "productos"}, "max_rows": {"type": int, "default": 100_000}}
    for name in ("preview", "validate"):
        command(name, "path", "--entity", "--profile", "--sheet", "--out", "--max-rows", **table)
    needed = {"required": True}
    command("inspect", "--out", "--run-id", out=needed, run_id=needed)
    command("approve", "--out", "--run-id", "--by", out=needed, run_id=needed, by=needed)
    command("publish", "--out", "--run-id", "--confirm", out=needed, run_id=needed, confirm={"action": "store_true"})
    command("batch", "path", "--rules", "--out", "--columns", "--engine", "--gate", out=needed, columns={"type": int, "default": 1}, engine={"default": "auto"}, gate={"action": "store_true"})
    command("review", "path", "--out", out=needed)
    command("enrich-variants", "--products", "--variants", "--prices", "--out", products=needed, variants=needed, prices=needed, out=needed)
    return p


def _say(value: object) -> None:
    print(json.dumps(value, ensure_ascii=False, default=str, indent=2))


def _batch(spark: SparkSession, a: argparse.Namespace) -> int:
    rules = batch_rules(a.rules) if a.rules else flows.BatchRules()
    blocks = read_documents(spark, a.path, engine=a.engine)
    made = flows.batch(blocks.where("error is null and text is not null"), rules, failures(blocks), columns=a.columns, gate=a.gate)
    for entity, checked in (("productos", made.products), ("variantes", made.variants)):
        checked.rows.write.mode("overwrite").parquet(f"{a.out}/{entity}-candidatos.parquet")
        checked.quarantine.write.mode("overwrite").parquet(f"{a.out}/{entity}-cuarentena.parquet")
        sinks.write_csv(sinks.csv_text(checked.rows, entity, present_only=False), f"{a.out}/{entity}.csv")
    sinks.write_csv(sinks.category_csv(made.categories.withColumn("page_number", F.col("page_number"))), f"{a.out}/categorias.csv")
    made.unnamed.write.mode("overwrite").json(f"{a.out}/sin-nombre.jsonl")
    report = made.report(a.gate)
    runs.write_text(spark, f"{a.out}/report.json", flows.profile_json(report) + "\n")
    runs.write_text(spark, f"{a.out}/batch-config.json", flows.profile_json(rules) + "\n")
    _say(report)
    return 0 if report["approved_for_publish"] else 2


def _enrich(spark: SparkSession, a: argparse.Namespace) -> int:
    products, variants, listed = (read_table(spark, x) for x in (a.products, a.variants, a.prices))
    variants = variants.withColumn("atributos", parse.attributes(F.col("atributos"))["value"])
    for c in ("precio", "costo"):
        products, variants = (df if c in df.columns else df.withColumn(c, F.lit("")) for df in (products, variants))
    rows = listed.select(F.col("row_number").alias("price_id"), F.col("sku").alias("target"), F.col("nombre").alias("raw_name"), parse.price_number(F.col("precio")).alias("price"), parse.price_number(F.col("costo")).alias("cost"), F.col("row_number").alias("source_row"))
    done = flows.enrich_variants(products, variants, rows)
    conflicts = done.conflicts.collect()
    if conflicts:
        _say({"conflicts": [r.asDict() for r in conflicts]})
        return 2
    sinks.write_csv(sinks.source_shaped(done.products, [c for c in products.columns if c not in ("source_file", "row_number")]), f"{a.out}/productos.csv")
    sinks.write_csv(sinks.source_shaped(done.variants, [c for c in variants.columns if c not in ("source_file", "row_number")]), f"{a.out}/variantes.csv")
    _say({"unmatched": done.unmatched.count(), "problems": {r.problem: r.n for r in done.problems.collect()}})
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("saltmarsh").getOrCreate()
    if a.command == "preview":
        _say(preview(read_table(spark, a.path, a.sheet), a.entity))
        return 0
    if a.command == "validate":
        profile = mapping_profile(a.profile) if a.profile else None
        run, _ = runs.validate_file(spark, a.path, profile.entity if profile else a.entity, profile and profile.columns, profile and profile.defaults, a.out, a.max_rows, a.sheet or (profile and profile.sheet))
        print(run.manifest())
        return 0 if run.status == "ready" else 2
    if a.command == "batch":
        return _batch(spark, a)
    if a.command == "enrich-variants":
        return _enrich(spark, a)
    if a.command == "review":
        products = read_table(spark, a.path)
        told = quality.assess(products, "descripcion")
        sinks.write_review(sinks.review_rows(flows.review(products, told)), a.out)
        return 0
    run = runs.Run.read(spark, a.out, a.run_id)
    if a.command == "approve":
        run.approve(a.by)
    if a.command == "publish":
        service = ImportService(os.environ.get("IMPORT_BASE_URL", ""), os.environ.get("IMPORT_API_TOKEN", ""), os.environ.get("IMPORT_TENANT", ""))
        rows = spark.read.parquet(f"{a.out}/{run.run_id}/{run.entity}.parquet").drop("_run_id", "_source_row")
        text = sinks.csv_text(rows.select(*[f.name for f in fields_for(run.entity)]), run.entity)
        try:
            runs.publish(run, text, service, a.confirm)
        finally:
            run.write(spark, a.out)
    if a.command != "inspect":
        run.write(spark, a.out)
    print(run.manifest())
    return 0


if __name__ == "__main__":
    sys.exit(main())
