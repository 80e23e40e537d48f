"""Lifecycle of a run: validated, ready or blocked, approved, publishing, published or failed; driver-side metadata and small files."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import mapping as mapper
from .operators.validation import Validated, validate
from .sinks import write_processed
from .sources.remote import ImportService
from .sources.tables import read_table

MOVES = {"validated": ("ready", "blocked"), "ready": ("approved",), "approved": ("publishing",), "publishing": ("published", "publish_failed"), "blocked": (), "published": (), "publish_failed": ()}


@dataclass
class Run:
    entity: str
    source_file: str
    source_sha256: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    status: str = "validated"
    created_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())
    report: dict = field(default_factory=dict)
    approved_by: str | None = None

    def move(self, status: str) -> None:
        if status not in MOVES[self.status]:
            raise ValueError(f"a run that is {self.status} cannot become {status}")
        self.status = status

    def manifest(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True, indent=2)

    def write(self, spark: SparkSession, folder: str) -> None:
        """The manifest, and the report beside it, under the run's name."""
        write_text(spark, f"{folder}/manifests/{self.run_id}.json", self.manifest() + "\n")
        write_text(spark, f"{folder}/reports/{self.run_id}.json", json.dumps(self.report, ensure_ascii=False, sort_keys=True, default=str) + "\n")

    @classmethod
    def read(cls, spark: SparkSession, folder: str, run_id: str) -> Run:
        return cls(**json.loads(read_text(spark, f"{folder}/manifests/{run_id}.json")))

    def approve(self, who: str) -> None:
        """Only a ready run with valid and without invalid rows, by someone named."""
        if not who.strip():
            raise ValueError("an approver is needed")
        if self.status != "ready" or self.report.get("invalid_rows") or not self.report.get("valid_rows"):
            raise ValueError("the run is not ready to be approved")
        self.move("approved")
        self.approved_by = who


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in any store that Spark can write to."""
    fs, place = _place(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.format("binaryFile").load(path).select("content").first().content.decode()


def file_digest(spark: SparkSession, path: str) -> str:
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first().h


def directory_digests(files: DataFrame) -> DataFrame:
    """(folder, digest, n_files): a digest over the ordered paths and digests of each folder's files (folder, path, content).

    A file is digested where it is read; a folder's paths and digests are one row, as its digest is over all of them in order.
    """
    lines = files.select("folder", "path", F.concat("path", F.lit("\0"), F.sha2("content", 256), F.lit("\n")).alias("line"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "line"))), lambda x: x["line"]), "")
    return lines.groupBy("folder").agg(F.sha2(whole, 256).alias("digest"), F.count("*").alias("n_files"))


def keep_raw(spark: SparkSession, path: str, folder: str, run_id: str) -> str:
    """A copy of an input file under the run's name, never replaced; where it is."""
    fs, source = _place(spark, path)
    kept = f"{folder}/raw/{run_id}__{source.getName()}"
    to, target = _place(spark, kept)
    if to.exists(target):
        raise FileExistsError(kept)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, to, target, False, spark._jsc.hadoopConfiguration())
    return kept


def validate_file(spark: SparkSession, path: str, entity: str, columns: Mapping[str, str] | None = None, defaults: Mapping[str, object] | None = None, out: str | None = None, max_rows: int = 100_000, sheet: str | None = None) -> tuple[Run, Validated]:
    """Read, map, parse, validate; valid rows, the rest, the raw file and the run's records are written where ``out`` says.

    Suggested columns stand in for none given.
    """
    table = read_table(spark, path, sheet)
    data = [c for c in table.columns if c not in ("source_file", "row_number")]
    rows = mapper.limit_rows(mapper.drop_blank(table, data), max_rows)
    records = mapper.apply(rows, dict(columns or mapper.suggest(data, entity)), entity, defaults)
    checked = validate(records, entity, coercion=F.col("coercion"))
    run = Run(entity, path, file_digest(spark, path))
    run.report = checked.report().first().asDict()
    run.move("ready" if run.report["approved_for_publish"] else "blocked")
    if out:
        keep_raw(spark, path, out, run.run_id)
        write_processed(checked.valid.drop("coercion"), entity, f"{out}/{run.run_id}", run.run_id)
        checked.quarantine.drop("coercion").write.parquet(f"{out}/{run.run_id}/quarantine.parquet")
        run.write(spark, out)
    return run, checked


def csv_lines(records: DataFrame) -> Iterator[bytes]:
    """Records as CSV with a header, a line at a time: no more than a partition is on the driver."""
    out = io.StringIO(newline="")
    writer = csv.writer(out)
    writer.writerow(records.columns)
    for r in records.toLocalIterator():
        yield out.getvalue().encode()
        out.seek(0)
        out.truncate()
        writer.writerow(["" if v is None else v for v in r])
    yield out.getvalue().encode()


def publish(run: Run, records: DataFrame, service: ImportService, confirm: bool) -> Run:
    """Send an approved run, first as a trial, then for good; records are text, under the names of the import's fields.

    A trial that tells no number of failed rows, or one above 0, ends the run, and so does any error.
    """
    if not confirm:
        raise ValueError("publishing needs to be confirmed")
    run.move("publishing")
    names = {c: c for c in records.columns}
    try:
        for trial in (True, False):
            done = service.wait(service.send(run.entity, f"{run.run_id}__{run.entity}.csv", csv_lines(records), names, trial))
            told = done.get("resultado")
            if trial and (not isinstance(told, dict) or "fallidos" not in told or int(told["fallidos"])):
                raise ValueError("the trial failed; nothing was published")
        run.report = run.report | {"published": told}
        run.move("published")
    except Exception:
        run.move("publish_failed")
        raise
    return run
