"""A whole run: raw check, bronze, main load, held-out load, report."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.numbers import ceil_div
from ledgerlake.operators.clean import FIRST_VERSION, is_garbled, to_bronze
from ledgerlake.operators.completeness import check_layer, expected_sources, layer_totals, missing_sources
from ledgerlake.operators.reconcile import audit_row, drift, reconcile, verdict
from ledgerlake.operators.stats import direct_stats, report_stats
from ledgerlake.plans.report import report_lines, report_row
from ledgerlake.settings import BATCH_SIZE, FILES_PER_LOAD, Feed
from ledgerlake.sinks.tables import append_audit, drop_partitions, write_bronze, write_report
from ledgerlake.sources.csvfiles import FILES_PER_SCAN, file_id, inspected, layout_scans
from ledgerlake.sources.listing import count_sources, list_files, literal_paths
from ledgerlake.sources.manifest import CONVERTED, QUARANTINED, WITHDRAWN, changes, commit, current, history, manifest_path
from ledgerlake.sources.parquetfiles import parquet_footers, parquet_profile
from ledgerlake.streaming.ingest import HELD_OUT_PHASE, MAIN, Store, bronze_stream, ingest_available
from ledgerlake.workspace import literal_rows, read_if_any, written


@dataclass
class RunLog:
    """What every step did, kept in order."""

    entries: list[tuple] = field(default_factory=list)

    def step(self, name: str, critical: bool, work: Callable[[], tuple[int, str]]) -> bool:
        """Run one step. A failing critical step raises; any other failure is noted."""
        start = time.monotonic()
        try:
            rows, message = work()
            status = "completed"
        except Exception as problem:
            rows, message, status = 0, str(problem), "failed"
            if critical:
                self._add(name, critical, status, rows, start, message)
                raise
        self._add(name, critical, status, rows, start, message)
        return status == "completed"

    def _add(self, name, critical, status, rows, start, message) -> None:
        self.entries.append(
            (len(self.entries) + 1, name, critical, status, rows, time.monotonic() - start, message)
        )

    def frame(self, spark: SparkSession) -> DataFrame:
        return literal_rows(
            spark,
            "step_no int, step string, critical boolean, status string, rows bigint, seconds double, message string",
            self.entries,
        )


@dataclass(frozen=True)
class Layout:
    """Folders of one installation."""

    raw: str
    lake: str

    @property
    def bronze(self) -> str:
        return f"{self.lake}/bronze"

    @property
    def audit(self) -> str:
        return f"{self.lake}/stats_verification"

    @property
    def reports(self) -> str:
        return f"{self.lake}/reports"

    def store(self, scale: int | None) -> Store:
        return Store(f"{self.lake}/store", scale, record=manifest_path(self.bronze))


def _next_version(spark: SparkSession, bronze: str, record: str) -> int:
    """Above every version that was committed. Versions that a conversion wrote and did not commit are
    removed, and their numbers are not used again: a stream may have read them."""
    used = {0}
    for path in (bronze, record):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.listStatus(folder) if files.exists(folder) else []
        names = [f.getPath().getName() for f in found]
        used.add(max((int(n.partition("=")[2]) for n in names if "version=" in n), default=0))
        if path == bronze:
            written_only = {int(n.partition("=")[2]) for n in names if n.startswith("bronze_version=")}
        else:
            written_only -= {int(n.partition("=")[2]) for n in names if n.startswith("version=")}
    for version in written_only - {FIRST_VERSION}:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{bronze.rstrip('/')}/bronze_version={version}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return 1 + max(used)


def convert_to_bronze(
    spark: SparkSession, raw: str, bronze: str, sources: Sequence[str] | None = None, batch_size: int = BATCH_SIZE,
    files_per_scan: int = FILES_PER_SCAN,
) -> DataFrame:
    """CSV files of a folder to bronze; ``sources`` names the wanted ones.

    Only files that are new, have changed or could not be converted before are read. Each one
    replaces what bronze has of it; rows of a file that is gone are withdrawn. A file that cannot
    be read, lacks a column or is not UTF-8 is quarantined with its reason, and the others go on.
    Files are converted in portions of ``files_per_scan``, each committed by itself, so a run that
    dies goes on where it was. Returns one row per file that was looked at.
    """
    record = manifest_path(bronze)
    present = list_files(spark, raw, "*.csv*").withColumn("file_id", file_id(F.col("path")))
    files = written(present.where(F.col("source_file").isin(*sources)) if sources else present, "files")
    changed, gone = changes(spark, record, files, sources)
    looked = written(inspected(changed), "inspected")
    version = _next_version(spark, bronze, record)
    facts = ("path", "file_id", "source_file", "file_name", "file_size", "modified_at")
    nothing = F.lit(0).cast("bigint")

    def commit_as(rows: DataFrame) -> None:
        nonlocal version
        commit(rows.withColumn("version", F.lit(version).cast("bigint")).select(*[c.split(" ")[0] for c in schemas.MANIFEST.split(", ")]), record)
        version += 1

    if not gone.isEmpty():
        commit_as(gone.withColumns({"state": F.lit(WITHDRAWN), "reason": F.lit("file is gone"), "row_count": nothing, "batches": nothing}))
    unusable = looked.where(F.col("reason").isNotNull())
    if not unusable.isEmpty():
        commit_as(unusable.select(*facts, F.lit(QUARANTINED).alias("state"), "reason", nothing.alias("row_count"), nothing.alias("batches")))
    for paths, rows in layout_scans(spark, looked.where(F.col("reason").isNull()), files_per_scan=files_per_scan):
        write_bronze(to_bronze(rows, version=F.lit(version)), bronze)
        made = read_if_any(spark, f"{bronze.rstrip('/')}/bronze_version={version}", schemas.BRONZE, base=bronze)
        made = made.groupBy("file_id").agg(F.count("*").alias("n_rows"), F.count_if(is_garbled()).alias("n_garbled"))
        mine = written(literal_paths(spark, paths), "portion").join(looked, "path").join(made, "file_id", "left")
        bad = F.coalesce(F.col("n_garbled") > 0, F.lit(False))
        count = F.when(bad, 0).otherwise(F.coalesce("n_rows", nothing))
        commit_as(mine.select(
            *facts, F.when(bad, QUARANTINED).otherwise(CONVERTED).alias("state"),
            F.when(bad, F.concat(F.lit("not UTF-8 in rows: "), F.col("n_garbled"))).alias("reason"),
            count.alias("row_count"), ceil_div(count, batch_size).cast("bigint").alias("batches"),
        ))
    now = current(spark, record)
    return changed.select("file_id").join(now, "file_id").select(
        "source_file", "file_name", (F.col("state") == CONVERTED).alias("converted"), "reason", "file_size", "row_count", "batches"
    )


def vacuum_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """Deletes versions of which no file counts any more; returns their numbers. Run it between loads."""
    record = manifest_path(bronze)
    alive = current(spark, record).where(F.col("state") == CONVERTED).select("version").distinct()
    dead = written(history(spark, record).select("version").distinct().join(alive, "version", "left_anti"), "dead-versions")
    drop_partitions(dead, bronze, "bronze_version")
    return dead


def bronze_profile(spark: SparkSession, bronze: str) -> DataFrame:
    """Rows per source by the manifest, files and bytes by the footers of the versions that count.

    A source that was converted to no rows is there with none; so is one without a manifest, by
    its footers alone.
    """
    facts = ("n_files", "row_count", "file_size", "corrupt_files")
    stored = list_files(spark, bronze, "*.parquet") if _exists(spark, bronze) else None
    files = current(spark, manifest_path(bronze)).where(F.col("state") == CONVERTED)
    if files.isEmpty():
        return parquet_profile(parquet_footers(stored)).select("source_file", *facts) if stored else literal_rows(
            spark, "source_file string, " + ", ".join(f"{c} bigint" for c in facts), [])
    alive = written(files.groupBy("source_file", "version").agg(F.sum("row_count").alias("rows"), F.count("*").alias("converted")), "alive")
    if stored is None:
        found = alive.groupBy("source_file").agg(F.lit(0).cast("bigint").alias("file_size"), F.lit(0).cast("bigint").alias("corrupt_files"))
    else:
        version = F.regexp_extract("path", r"/bronze_version=(\d+)/", 1).cast("bigint")
        footers = parquet_footers(stored.join(alive, (stored["source_file"] == alive["source_file"]) & (version == alive["version"]), "left_semi"))
        found = parquet_profile(footers).select("source_file", "file_size", "corrupt_files")
    rows = alive.groupBy("source_file").agg(F.sum("converted").alias("n_files"), F.sum("rows").alias("row_count"))
    return rows.join(found, "source_file", "left").select(
        "source_file", "n_files", "row_count", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in facts[2:]]
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def load_phase(
    spark: SparkSession, layout: Layout, feed: Feed, phase: str, scale: int | None, max_files: int | None = None,
    verify_every: int = 0,
) -> Store:
    """Load the main sources, or the held-out one, into the store; others stay in bronze.

    ``verify_every`` reconciles after every so many micro-batches; each time re-reads the store.
    """
    store = layout.store(scale)
    pick = F.col("source_file").isin(*([feed.held_out] if phase == HELD_OUT_PHASE else feed.main))

    def verify(number: int) -> None:
        if verify_every and (number + 1) % verify_every == 0:
            verify_store(spark, store, layout, f"{phase}-{number}")

    stream = bronze_stream(spark, layout.bronze, lambda rows: rows.where(pick), max_files or FILES_PER_LOAD)
    ingest_available(stream, store, phase, verify)
    return store


def verify_store(spark: SparkSession, store: Store, layout: Layout, run_id: str, publish: bool = True) -> DataFrame:
    """Reconcile state and store, and put the result into the audit table."""
    state, direct = store.state(spark), direct_stats(store.transactions(spark), store.scale)
    comparison = written(reconcile(state, direct), "comparison")
    if publish:
        append_audit(audit_row(state, direct, comparison, run_id), layout.audit)
    return verdict(comparison)


def phase_drift(spark: SparkSession, store: Store) -> DataFrame:
    """What the held-out phase changed, from the partials of both phases."""
    names = ("count", "avg", "min", "max")
    before = store.state(spark, MAIN).select(F.struct(*names)).scalar()
    sides = store.state(spark).select(F.struct(*names).alias("after"), before.alias("before"))
    return drift(sides.select(*[F.col(f"{side}.{n}").alias(f"{n}_{side}") for side in ("before", "after") for n in names]))


def run_all(
    spark: SparkSession, layout: Layout, feed: Feed, scale: int | None = None, batch_size: int = BATCH_SIZE,
    run_id: str | None = None, publish: bool = True, max_files: int | None = None, strict: bool = True,
) -> DataFrame:
    """The five steps in order; returns the step log.

    Raw data, bronze and the main load are critical: their failure ends the run. The
    held-out load and the report are not. ``publish=False`` leaves out audit and report.
    With ``strict`` an expected source that is not there, or cannot be converted, ends the run;
    otherwise it is a warning in the log and the others are loaded.
    Without ``run_id`` the run gets one of its own, so its audit rows are added to earlier ones.
    """
    run_id = run_id or uuid.uuid4().hex
    log = RunLog()
    expected = expected_sources(spark, feed.expected)

    def raw_data() -> tuple[int, str]:
        files = list_files(spark, layout.raw, "*.csv*")
        absent = missing_sources(files, expected).count()  # at most the length of the expected list
        if absent and strict:
            raise FileNotFoundError(f"{absent} expected sources are missing")
        message = f"warning: {absent} expected sources are missing" if absent else "all expected sources are there"
        return files.select("source_file").distinct().count(), message

    def bronze() -> tuple[int, str]:
        convert_to_bronze(spark, layout.raw, layout.bronze, feed.expected)
        totals = layer_totals(check_layer(bronze_profile(spark, layout.bronze), expected)).first()
        if totals["valid"]:
            return totals["total_rows"], "bronze is complete"
        trouble = f"bronze is not complete: {totals['missing']} missing, {totals['corrupt']} corrupt"
        if strict or totals["missing"] == totals["files_expected"] or totals["corrupt"]:
            raise ValueError(trouble)
        return totals["total_rows"], f"warning: {trouble}"

    def main_load() -> tuple[int, str]:
        store = load_phase(spark, layout, feed, MAIN, scale, max_files)
        if not verify_store(spark, store, layout, f"{run_id}-main", publish).first()["overall_match"]:
            raise ValueError("incremental and stored statistics differ")
        return store.state(spark).first()["count"], "statistics match"

    def held_out_load() -> tuple[int, str]:
        store = load_phase(spark, layout, feed, HELD_OUT_PHASE, scale, max_files)
        match = verify_store(spark, store, layout, f"{run_id}-held-out", publish).first()["overall_match"]
        return phase_drift(spark, store).first()["count_added"], "statistics match" if match else "statistics differ"

    def report() -> tuple[int, str]:
        store = layout.store(scale)
        row = written(
            report_row(
                count_sources(list_files(spark, layout.bronze, "*.parquet")),
                report_stats(store.transactions(spark), scale), store.state(spark), batch_size,
            ),
            "report",
        )
        if publish:
            write_report(row, report_lines(row), layout.reports)
        return row.first()["total_records"], "report written" if publish else "report not published"

    try:
        log.step("raw_data", True, raw_data)
        log.step("bronze", True, bronze)
        log.step("ingestion", True, main_load)
        log.step("validation", False, held_out_load)
        log.step("report", False, report)
    except Exception:
        pass  # the failed critical step is in the log
    return log.frame(spark)


def run_succeeded(steps: DataFrame) -> DataFrame:
    """Whether all three critical steps are done."""
    done = F.count_if(F.col("critical") & (F.col("status") == "completed"))
    return steps.agg(
        F.count_if(F.col("status") == "completed").alias("steps_completed"),
        F.count_if(F.col("status") == "failed").alias("steps_failed"),
        (done == 3).alias("overall_success"),
    )
