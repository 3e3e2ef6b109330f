"""The daily data product: sources, landing, control, marts, reconciliation, publication.

Each stage adds its findings to one gate table (stage, finding, value, limit) and ends the run
when one of them is beyond its limit. Tables are written to folders of the run and facts are
merged without being published; only the last stage, after all gates, switches readers over, by one
file that names the folder of every table and the version of every fact. So a
failed run leaves the state of the last good one, wherever it fails. All reports carry the run's id, and
evidence counts a report only if it belongs to the newest run. Only one-row summaries
reach the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from omnimart.functions.scalars import HALF_CENT
from omnimart.operators import files
from omnimart.operators.checks import run_checks, score, summary
from omnimart.operators.cube import sales_cube
from omnimart.operators.snapshot import Snapshot
from omnimart.operators.tables import (
    LOADED_AT,
    KeyedTable,
    landed_files,
    later_than,
    write_cube,
    write_raw_zone,
)
from omnimart.plans import contracts, core, marts, quality, reports, staging
from omnimart.session import pin, released
from omnimart.sources.landing import source_counts
from omnimart.sources.schemas import SOURCE_NAMES
from omnimart.streaming.sinks import json_lines, write_json_lines

PASS, FAIL, SKIPPED, NOT_RUN = "PASS", "FAIL", "SKIPPED", "NOT_RUN"
PUBLISHED = "PUBLISHED"
DUE = "08:00 Europe/Paris"

# Incremental facts: key and event time.
FACTS = {"fct_sales": ("order_id", "ordered_at"), "fct_retail_event": ("event_id", "event_at")}

STOCK_COLUMNS = ("store_stock", "warehouse_stock", "reserved", "incoming", "safety_stock")


class GateClosed(ValueError):
    """A check or a reconciliation failed, so nothing is published."""


@dataclass
class DailyRun:
    spark: SparkSession
    source: staging.Source
    root: str
    as_of: datetime
    land_raw: bool = True
    full_refresh: bool = False
    phases: list[dict] = field(default_factory=list)
    gates: list[dict] = field(default_factory=list)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def __post_init__(self) -> None:
        self._written: dict[str, str] = {}
        self._facts: dict[str, KeyedTable] = {}
        self._kpis: dict = {}

    # -- helpers -----------------------------------------------------------

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def report(self, name: str, content: dict) -> dict:
        written = datetime.now(timezone.utc).isoformat()
        content = {**content, "run_id": self.run_id, "generated_at": written}
        return files.write_json(self.spark, self.path("reports", f"{name}.json"), content)

    def current(self) -> dict:
        """What readers see: the newest switch file, with folders, fact versions and KPIs."""
        names = [n for n in files.children(self.spark, self.path("tables", "current")) if n[0] != "."]
        return files.read_json(self.spark, self.path("tables", "current", names[-1])) if names else {}

    def published(self) -> dict[str, str]:
        """Folder of each full-refresh table, as readers see it."""
        return self.current().get("folders", {})

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(self._written.get(name) or self.published()[name]))

    def new_folder(self, name: str) -> str:
        self._written[name] = f"tables/{name}/run-{self.run_id}"
        return self.path(self._written[name])

    def refresh(self, name: str, df: DataFrame) -> DataFrame:
        """Full-refresh table, in a folder of this run."""
        df.write.parquet(self.new_folder(name))
        return self.stored(name)

    def timed(self, name: str, stage: Callable[..., dict], *inputs: dict) -> dict:
        started, status = time.perf_counter(), FAIL
        try:
            result = stage(*inputs)
            status = result["status"]
        finally:
            took = round((time.perf_counter() - started) * 1000, 1)
            self.phases.append({"name": name, "status": status, "duration_ms": took})
        return result

    def gate(self, stage: str, finding: str, value, limit=0) -> None:
        """Enter a finding; beyond its limit it closes the gate."""
        entry = {"stage": stage, "finding": finding, "value": float(value), "limit": float(limit)}
        self.gates.append({**entry, "passed": abs(entry["value"]) <= entry["limit"]})

    def pass_gate(self, stage: str) -> None:
        """End the run if a finding of the stage, or of one before it, is beyond its limit."""
        closed = [g for g in self.gates if not g["passed"]]
        if closed:
            self.report("gates", {"status": FAIL, "stage": stage, "gates": self.gates})
            raise GateClosed("; ".join(f"{g['stage']}: {g['finding']} {g['value']:g}" for g in closed))

    # -- stages ------------------------------------------------------------

    def extract(self) -> dict:
        """Count the records of every source."""
        if hasattr(self.source, "check_present"):
            self.source.check_present()
        counts = {r["source"]: r["records"] for r in source_counts(self.source).collect()}
        damaged = {}
        if hasattr(self.source, "quarantine"):
            damaged = {name: self.source.quarantine(name).count() for name in SOURCE_NAMES}
        self.gate("extract", "damaged lines", sum(damaged.values()))
        result = self.report(
            "source_report",
            {
                "status": PASS if not any(damaged.values()) else FAIL,
                "sources": len(counts),
                "records": sum(counts.values()),
                "record_counts": counts,
                "damaged_lines": damaged,
            },
        )
        self.pass_gate("extract")
        return result

    def land(self, extracted: dict) -> dict:
        """Copy the sources to the raw zone and the events to JSON lines, then audit both."""
        if not self.land_raw:
            return {"status": SKIPPED}
        day = self.as_of.strftime("%Y-%m-%d")
        folders = {
            name: write_raw_zone(self.source.table(name), self.root, name, day, self.as_of)
            for name in SOURCE_NAMES
        }
        audit = landed_files(self.spark, folders, day).agg(
            F.sum("files").alias("objects"), F.sum("bytes").alias("bytes")
        )
        lines = pin(json_lines(self.source.table("retail_events")), "event-lines")
        invalid = lines.filter("not valid").count()
        self.gate("land", "invalid events", invalid)
        self.pass_gate("land")
        folder = self.path("raw", "event_lines", f"ingestion_date={day}")
        write_json_lines(lines, folder)
        written = self.spark.read.text(folder).count()
        expected = extracted["record_counts"]["retail_events"]
        self.gate("land", "events not written", expected - written)
        self.pass_gate("land")
        return self.report(
            "landing_report",
            {
                "status": PASS,
                **files.one_row(audit),
                "events_published": written,
                "failed_records": 0,
                "validated_events": written,
            },
        )

    def judge_freshness(self) -> dict:
        """Age of the newest stored load of each source, read back from its newest day in the raw zone.

        Old loads are reported, very old or missing ones close the gate. A run without a raw zone has nothing to judge.
        """
        loaded = {}
        for name in SOURCE_NAMES:
            days = [d for d in files.children(self.spark, self.path("raw", name)) if "=" in d]
            if days:
                newest = self.spark.read.parquet(self.path("raw", name, days[-1]))
                stamped = LOADED_AT in newest.columns
                loaded[name] = newest if stamped else newest.withColumn(LOADED_AT, F.lit(None).cast("timestamp"))
        if not loaded:
            return {"status": SKIPPED}
        ages = [r.asDict() for r in quality.freshness(loaded, LOADED_AT, self.as_of).collect()]
        missing = sorted(set(SOURCE_NAMES) - set(loaded))
        states = [a["status"] for a in ages] + ["error"] * len(missing)
        self.gate("freshness", "stale sources", states.count("error"))
        status = FAIL if "error" in states else "WARN" if "warn" in states else PASS
        result = self.report("freshness_report", {"status": status, "sources": ages, "missing": missing})
        self.pass_gate("freshness")
        return result

    def control(self, extracted: dict) -> dict:
        """The contracts on the raw sources and the batch, stream and payment totals."""
        raw = contracts.stored(
            staging.typed_sources(self.source), "orders", "retail_events", "payments"
        )
        results = pin(contracts.run_contracts(raw, self.as_of), "contracts")
        quality_row = files.one_row(score(contracts.as_check_results(results)))
        quality_row["checks"] = {r["contract"]: r["passed"] for r in results.collect()}
        reconciliation = files.one_row(total_reconciliation(raw))
        newest = raw["retail_events"].agg(F.max("event_at").cast("timestamp_ntz")).first()[0]
        age = (self.as_of - newest).total_seconds() / 60 if newest else None
        quality_row["freshness_minutes"] = None if age is None else round(age, 1)
        quality_row["row_counts"] = extracted["record_counts"]
        self.gate("control", "failed contracts", quality_row["failed"])
        self.gate("control", "unit delta", reconciliation["unit_delta"])
        self.gate("control", "payment delta", reconciliation["amount_delta"], HALF_CENT)
        report = {"quality": quality_row, "reconciliation": reconciliation}
        self.report("quality_report", {**report, "run": {"phases": self.phases}})
        self.pass_gate("control")
        return {"status": quality_row["status"], **report}

    def build_marts(self, controlled: dict) -> dict:
        """Dimensions, incremental facts, stock history, marts and their checks."""
        src, tables = self.source, {}
        for name in ("stg_customers", "stg_products", "stg_inventory", "stg_price_history"):
            tables[name] = getattr(staging, name)(src)
        tables["stg_customer_identities"] = pin(staging.stg_customer_identities(src), "identities")
        tables["stg_orders"] = staging.stg_orders(src)
        tables["stg_payments"] = pin(staging.stg_payments(src), "payments")
        tables["stg_retail_events"] = staging.stg_retail_events(src)
        bridge = tables["identity_bridge"] = self.refresh(
            "identity_bridge",
            core.identity_bridge(tables["stg_customer_identities"], tables["stg_customers"]),
        )
        tables["dim_customer"] = self.refresh(
            "dim_customer", core.dim_customer(tables["stg_customers"], bridge)
        )
        tables["dim_product"] = self.refresh(
            "dim_product", core.dim_product(tables["stg_products"])
        )
        tables["dim_product_price"] = self.refresh(
            "dim_product_price", core.dim_product_price(tables["stg_price_history"])
        )
        sales = tables["fct_sales"] = self.load_fact(
            "fct_sales",
            lambda since: core.fct_sales(staging.stg_orders(src, since), bridge),
        )
        events = tables["fct_retail_event"] = self.load_fact(
            "fct_retail_event",
            lambda since: core.fct_retail_event(staging.stg_retail_events(src, since), bridge),
        )
        payments = tables["fct_payments"] = self.refresh(
            "fct_payments", core.fct_payments(tables["stg_payments"])
        )
        stock = tables["stg_inventory"]
        history = Snapshot(self.spark, self.path("tables", "stock_history"), "product_id", STOCK_COLUMNS)
        history.table.held, history.table.at = True, self.current().get("facts", {}).get("stock_history", 0)
        self._facts["stock_history"] = history.table
        history.apply(stock.select("product_id", *STOCK_COLUMNS), self.as_of)
        available = tables["available_to_promise"] = self.refresh(
            "available_to_promise", marts.available_to_promise(stock, sales)
        )
        tables["payment_reconciliation"] = self.refresh(
            "payment_reconciliation", marts.payment_reconciliation(sales, payments)
        )
        tables["customer_rfm"] = self.refresh(
            "customer_rfm", marts.customer_rfm(sales, tables["dim_customer"])
        )
        tables["repricing"] = self.refresh(
            "repricing", marts.repricing(tables["dim_product"], stock, sales)
        )
        write_cube(sales_cube(sales, self.as_of), self.new_folder("sales_cube"))

        results = pin(run_checks(tables, quality.all_checks()), "checks")
        overall = files.one_row(score(results))
        kinds = [r.asDict() for r in summary(results).collect()]
        kpis = reports.kpi_record(
            sales, tables["dim_product"], events, available, controlled["quality"]["score"]
        )
        self._kpis = files.one_row(kpis)
        self.report(
            "mart_report",
            {
                "status": overall["status"],
                "models": len(tables),
                "tests": overall["total"],
                "snapshots": 1,
                "failed": overall["failed"],
                "by_kind": kinds,
            },
        )
        self.gate("marts", "failed table checks", overall["failed"])
        self.pass_gate("marts")
        return {"status": overall["status"], "tests": overall["total"]}

    def fact(self, name: str) -> KeyedTable:
        """Stored fact, in folders by day."""
        key, time = FACTS[name]
        if name not in self._facts:
            day = F.date_format(time, "yyyy-MM-dd")
            version = self.current().get("facts", {}).get(name, 0)
            self._facts[name] = KeyedTable(self.spark, self.path("tables", name), key, day, held=True, at=version)
        return self._facts[name]

    def load_fact(self, name: str, build: Callable[[datetime | None], DataFrame]) -> DataFrame:
        """Merge rows newer than the stored maximum, or rebuild on a full refresh."""
        table, (_, time) = self.fact(name), FACTS[name]
        if self.full_refresh:
            table.overwrite(core.stamp(build(None)))
        else:
            newest = table.watermark(time)
            table.merge(core.stamp(later_than(build(newest), time, newest)), time)
        return table.read().drop("transformed_at")

    def reconcile(self) -> dict:
        """The gate table as a report; every stage that ran must be in it."""
        stages = {g["stage"] for g in self.gates}
        for stage in ("extract", "control", "marts"):
            self.gate("reconcile", f"{stage} without findings", stage not in stages)
        self.pass_gate("reconcile")
        deltas = {g["finding"].replace(" ", "_"): g["value"] for g in self.gates if "delta" in g["finding"]}
        return self.report("gates", {"status": PASS, "stage": "reconcile", "gates": self.gates, **deltas})

    def publish(self, reconciled: dict) -> dict:
        """Switch readers to what this run wrote, then write the manifest, the last thing of all."""
        self.pass_gate("publish")
        if reconciled.get("run_id") != self.run_id or reconciled.get("status") != PASS:
            raise GateClosed("no passed gate table of this run")
        last = self.current()
        before = last.get("folders", {})
        # Manifests of facts are written first; no reader looks at them before the switch names their versions.
        for table in self._facts.values():
            table.publish()
        kpis = {**self._kpis, "run_id": self.run_id}
        current = {
            "number": last.get("number", 0) + 1,
            "run_id": self.run_id,
            "folders": {**before, **self._written},
            "facts": {**last.get("facts", {}), **{n: t.version for n, t in self._facts.items()}},
            "kpis": kpis,
        }
        content = json.dumps(current, ensure_ascii=False, default=str)
        files.publish_text(self.spark, self.path("tables", "current", f"{current['number']:010d}.json"), content)
        files.write_json(self.spark, self.path("curated", "kpis.json"), kpis)
        manifest = self.report(
            "publish_manifest",
            {
                "status": PUBLISHED,
                "sla": DUE,
                "artifacts": [
                    "curated/kpis.json",
                    "reports/quality_report.json",
                    "reports/mart_report.json",
                    "reports/gates.json",
                ],
                "tables": current["folders"],
                "reconciliation": reconciled,
                "phases": list(self.phases),
            },
        )
        self._tidy({*before.values(), *self._written.values()})
        return manifest

    def _tidy(self, kept: set[str]) -> None:
        """Delete table folders older than the previous publication, which readers may still use."""
        for name in self._written:
            for folder in files.children(self.spark, self.path("tables", name)):
                if f"tables/{name}/{folder}" not in kept:
                    files.delete(self.spark, self.path("tables", name, folder))
        for table in self._facts.values():
            table.tidy()

    def run(self) -> dict:
        """All stages; the run report names every one that ran, with its time, also where one failed."""
        status, started = FAIL, time.perf_counter()
        try:
            with released(self.spark):
                manifest = self._stages()
            status = manifest["status"]
            return manifest
        finally:
            total = round((time.perf_counter() - started) * 1000, 1)
            self.report("run_report", {"status": status, "phases": self.phases, "total_ms": total})

    def _stages(self) -> dict:
        extracted = self.timed("extract", self.extract)
        self.timed("land", self.land, extracted)
        self.judge_freshness()
        controlled = self.timed("control", self.control, extracted)
        self.timed("marts", self.build_marts, controlled)
        reconciled = self.timed("reconcile", self.reconcile)
        return self.timed("publish", self.publish, reconciled)


def total_reconciliation(raw: dict[str, DataFrame]) -> DataFrame:
    """Units of orders and purchase events, amounts of orders and payments, in one row.

    Each source adds its totals to one column and zero to the others.
    """
    amount = F.col("quantity") * F.col("unit_price")
    zero_units, zero_money = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(38,2)")

    def totals(df: DataFrame, **columns) -> DataFrame:
        return df.agg(
            *[
                F.coalesce(columns.get(name, default), default)
                .cast(kind)
                .alias(name)
                for name, default, kind in (
                    ("batch_units", zero_units, "bigint"),
                    ("stream_units", zero_units, "bigint"),
                    ("sales_amount", zero_money, "decimal(38,2)"),
                    ("payment_amount", zero_money, "decimal(38,2)"),
                )
            ]
        )

    bought = F.when(F.col("event_type") == "purchase", F.col("quantity"))
    sums = (
        totals(raw["orders"], batch_units=F.sum("quantity"), sales_amount=F.sum(amount))
        .unionByName(totals(raw["retail_events"], stream_units=F.sum(bought)))
        .unionByName(totals(raw["payments"], payment_amount=F.sum("amount")))
    )
    return (
        sums.agg(
            F.sum("batch_units").alias("batch_units"),
            F.sum("stream_units").alias("stream_units"),
            F.sum("sales_amount").cast("decimal(18,2)").alias("sales_amount"),
            F.sum("payment_amount").cast("decimal(18,2)").alias("payment_amount"),
        )
        .withColumn("unit_delta", F.col("batch_units") - F.col("stream_units"))
        .withColumn(
            "amount_delta", (F.col("sales_amount") - F.col("payment_amount")).cast("decimal(18,2)")
        )
        .withColumn("status", reports.agreement(F.col("unit_delta"), F.col("amount_delta")))
    )


#: Reports in the order of the stages that write them, with the status of a finished stage.
STAGE_REPORTS = {
    "sources": ("source_report", PASS),
    "landing": ("landing_report", PASS),
    "quality": ("quality_report", None),
    "marts": ("mart_report", PASS),
    "gates": ("gates", PASS),
    "publication": ("publish_manifest", PUBLISHED),
}


def run_evidence(spark: SparkSession, root: str) -> dict:
    """State of the newest run from its own reports.

    The newest run is the one whose source report is stored. A report of another run, or
    none, reads as not run, so nothing old stands in for a stage that failed.
    """
    found = {
        step: files.read_json(spark, f"{root.rstrip('/')}/reports/{name}.json")
        for step, (name, _) in STAGE_REPORTS.items()
    }
    run_id = found["sources"].get("run_id")
    found = {k: r if run_id and r.get("run_id") == run_id else {} for k, r in found.items()}
    checks = found["quality"].get("quality", {})
    totals = found["quality"].get("reconciliation", {})
    states = {k: found[k].get("status") if done else checks.get("status") for k, (_, done) in STAGE_REPORTS.items()}
    done = {k: states[k] == (wanted or PASS) for k, (_, wanted) in STAGE_REPORTS.items()}
    if done["publication"]:
        status = PASS
    else:
        status = FAIL if FAIL in states.values() else NOT_RUN
    return {
        "run_id": run_id,
        "status": status,
        "publishable": done["quality"] and totals.get("status") == PASS and done["gates"],
        "quality": {
            **{k: checks.get(k) for k in ("status", "score", "total", "passed", "failed")},
            "privacy_ok": checks.get("checks", {}).get("privacy.email_hash_shape", False),
        },
        "unit_delta": totals.get("unit_delta"),
        "payment_delta": totals.get("amount_delta"),
        "source_records": found["sources"].get("records"),
        "landed_objects": found["landing"].get("objects"),
        "published_events": found["landing"].get("events_published"),
        "steps": {k: "executed" if ok else "not run" for k, ok in done.items()},
        "models": found["marts"].get("models"),
        "tests": found["marts"].get("tests"),
        "failed_tests": found["marts"].get("failed"),
        "snapshots": found["marts"].get("snapshots"),
        "manifest": found["publication"].get("status"),
    }
