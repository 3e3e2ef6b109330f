from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from omnimart.operators import files
from omnimart.operators.cube import reconciliation_cube
from omnimart.operators.checks import accepted
from omnimart.plans import quality, reports
from omnimart.plans.daily_run import DailyRun, GateClosed, run_evidence
from omnimart.sources.landing import LandingSource
from omnimart.sources.synthetic import SyntheticSource

END = datetime(2026, 9, 8, 19, 11)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """A first run over the default synthetic sources, read from CSV."""
    base = tmp_path_factory.mktemp("daily")
    SyntheticSource(spark, END).write_csv(str(base / "in"))
    source = LandingSource(spark, str(base / "in"))
    root = str(base / "out")
    before = run_evidence(spark, root)
    manifest = DailyRun(spark, source, root, END).run()
    return {"root": root, "source": source, "before": before, "manifest": manifest}


def test_run_publishes(published, spark):
    manifest, root = published["manifest"], published["root"]
    assert manifest["status"] == "PUBLISHED"
    assert manifest["reconciliation"]["unit_delta"] == 0
    assert manifest["reconciliation"]["payment_delta"] == 0
    assert all(g["passed"] for g in manifest["reconciliation"]["gates"])
    assert [p["name"] for p in manifest["phases"]] == ["extract", "land", "control", "marts", "reconcile"]
    for artifact in manifest["artifacts"]:
        assert files.exists(spark, f"{root}/{artifact}")
    sources = files.read_json(spark, f"{root}/reports/source_report.json")
    assert (sources["sources"], sources["records"]) == (8, 5928)
    checks = files.read_json(spark, f"{root}/reports/quality_report.json")["quality"]
    assert (checks["total"], checks["passed"], checks["score"]) == (24, 24, 100.0)
    assert sum(checks["row_counts"].values()) == 5928 and checks["freshness_minutes"] is not None
    marts = files.read_json(spark, f"{root}/reports/mart_report.json")
    assert (marts["models"], marts["tests"], marts["snapshots"]) == (19, 77, 1)
    landing = files.read_json(spark, f"{root}/reports/landing_report.json")
    assert landing["events_published"] == 3160 and landing["failed_records"] == 0


def test_tables_have_their_rows(published, spark):
    root = published["root"]
    run = DailyRun(spark, published["source"], root, END)
    assert run.stored("identity_bridge").count() == 640
    assert run.stored("dim_customer").count() == 160
    assert run.stored("dim_product_price").count() == 24
    assert run.stored("fct_payments").count() == 960
    assert run.stored("available_to_promise").filter("available_to_promise < 0").count() == 0
    assert run.stored("sales_cube").count() == 12


def test_evidence(published, spark):
    assert published["before"]["status"] == "NOT_RUN"
    assert set(published["before"]["steps"].values()) == {"not run"}
    after = run_evidence(spark, published["root"])
    assert (after["status"], after["publishable"], after["source_records"]) == ("PASS", True, 5928)
    assert after["quality"]["privacy_ok"] is True
    assert set(after["steps"].values()) == {"executed"}
    assert (after["published_events"], after["failed_tests"], after["manifest"]) == (3160, 0, "PUBLISHED")
    assert after["landed_objects"] >= 8 and after["unit_delta"] == 0


def test_second_run_is_incremental(published, spark):
    """The same extract again adds nothing and rewrites no fact partition."""
    root = published["root"]
    later = DailyRun(spark, published["source"], root, END + timedelta(hours=2), land_raw=False)
    facts = [f"{root}/tables/{t}/manifest" for t in ("fct_sales", "fct_retail_event")]
    before = [files.children(spark, f) for f in facts]
    assert later.run()["status"] == "PUBLISHED"
    assert [files.children(spark, f) for f in facts] == before
    history = spark.read.parquet(f"{root}/tables/stock_history/data")
    assert history.filter("valid_to is not null").count() == 0


class Changed:
    """A source with one table replaced."""

    def __init__(self, source, name, change):
        self.source, self.name, self.change = source, name, change

    def table(self, name, since=None):
        df = self.source.table(name, since)
        return self.change(df) if name == self.name else df


def test_dashboards_agree_for_every_selection(published, spark):
    """Blocks of a selection add up, stock ignores the selection, and batch equals stream."""
    run = DailyRun(spark, published["source"], published["root"], END)
    sales, events = run.fact("fct_sales").read(), run.fact("fct_retail_event").read()
    shared = [run.stored(t) for t in ("fct_payments", "dim_product", "dim_customer", "available_to_promise")]
    stock = set()
    for channel, period in (("all", 30), ("web", 7)):
        blocks = reports.dashboard(reports.Selection(END, channel, period), sales, events, *shared)
        kpi = blocks["kpis"].first()
        assert blocks["series"].agg(F.sum("revenue")).first()[0] == kpi["revenue"]
        assert blocks["channel_mix"].agg(F.sum("orders")).first()[0] == kpi["orders"]
        assert blocks["inventory"].agg(F.sum("selected_units_sold")).first()[0] == kpi["units"]
        agreed = blocks["reconciliation"].first()
        assert (agreed["unit_delta"], agreed["amount_delta"], agreed["status"]) == (0, 0, "PASS")
        stock.add(blocks["stock"].first()["total_atp"])
        assert blocks["customers"].count() == 20
    assert len(stock) == 1
    cells = reconciliation_cube(sales, events, shared[0], END).collect()
    assert len(cells) == 12 and all(c["unit_delta"] == 0 == c["amount_delta"] for c in cells)


def test_failed_contract_closes_the_gate(published, spark, tmp_path):
    source = Changed(
        published["source"], "payments", lambda d: d.withColumn("status", F.lit("pending"))
    )
    with pytest.raises(GateClosed, match="failed contracts"):
        DailyRun(spark, source, str(tmp_path / "out"), END, land_raw=False).run()
    assert not files.exists(spark, str(tmp_path / "out" / "reports" / "publish_manifest.json"))
    evidence = run_evidence(spark, str(tmp_path / "out"))
    assert (evidence["status"], evidence["publishable"]) == ("FAIL", False)


def test_a_failed_day_leaves_the_day_before(published, spark, tmp_path, monkeypatch):
    """Tables, facts and KPIs of day one stay as they are, and evidence speaks of day two."""
    root, later = str(tmp_path / "out"), END + timedelta(hours=2)
    DailyRun(spark, published["source"], root, END).run()
    first = DailyRun(spark, published["source"], root, END)
    before = {t: sorted(map(str, first.stored(t).collect())) for t in ("available_to_promise", "sales_cube")}
    facts = sorted(map(str, first.fact("fct_sales").read().collect()))
    kpis = files.read_json(spark, f"{root}/curated/kpis.json")
    day_one = run_evidence(spark, root)["run_id"]

    checks = [*quality.all_checks(), accepted("dim_product", "currency", ["none"])]
    monkeypatch.setattr(quality, "all_checks", lambda: checks)
    half = Changed(published["source"], "inventory", lambda d: d.withColumn("incoming", F.col("incoming") + 1))
    second = DailyRun(spark, half, root, later, full_refresh=True)
    with pytest.raises(GateClosed, match="table checks"):
        second.run()
    again = DailyRun(spark, published["source"], root, later)
    assert before == {t: sorted(map(str, again.stored(t).collect())) for t in before}
    assert facts == sorted(map(str, again.fact("fct_sales").read().collect()))
    assert files.read_json(spark, f"{root}/curated/kpis.json") == kpis
    evidence = run_evidence(spark, root)
    assert evidence["run_id"] == second.run_id != day_one
    assert evidence["status"] == "FAIL" and evidence["manifest"] is None and not evidence["publishable"]
    assert evidence["steps"]["publication"] == "not run" and evidence["failed_tests"] > 0


def test_damaged_lines_close_the_gate(spark, tmp_path):
    SyntheticSource(spark, END).write_csv(str(tmp_path / "in"))
    target = next((tmp_path / "in").glob("payments*"))
    part = next(target.glob("*.csv")) if target.is_dir() else target
    part.write_text(part.read_text() + "T-x,O-x,abc,EUR,settled,card,2026-09-01T10:00:00+00:00\n")
    for crc in part.parent.glob(f".{part.name}.crc"):
        crc.unlink()
    with pytest.raises(GateClosed, match="damaged lines 1"):
        DailyRun(spark, LandingSource(spark, str(tmp_path / "in")), str(tmp_path / "out"), END).run()
    assert run_evidence(spark, str(tmp_path / "out"))["status"] == "FAIL"


def test_gate_table(spark, published, tmp_path):
    run = DailyRun(spark, published["source"], str(tmp_path), END)
    for stage in ("extract", "control", "marts"):
        run.gate(stage, "rows", 0)
    run.gate("control", "payment delta", 0.004, 0.005)
    passed = run.reconcile()
    assert passed["status"] == "PASS" and passed["payment_delta"] == 0.004
    with pytest.raises(GateClosed):
        DailyRun(spark, published["source"], str(tmp_path), END).publish(passed)
    run.gate("control", "unit delta", -1)
    for stage in (run.reconcile, lambda: run.publish(passed)):
        with pytest.raises(GateClosed, match="unit delta -1"):
            stage()
    with pytest.raises(GateClosed, match="without findings"):
        DailyRun(spark, published["source"], str(tmp_path), END).reconcile()


def test_run_report_has_every_phase(published, spark):
    report = files.read_json(spark, f"{published['root']}/reports/run_report.json")
    assert report["status"] == "PUBLISHED" and report["total_ms"] >= sum(p["duration_ms"] for p in report["phases"])
    assert report["phases"][-1]["name"] == "publish" and all(p["status"] != "FAIL" for p in report["phases"])


def test_load_times_are_stored_and_judged(published, spark):
    stored = spark.read.parquet(f"{published['root']}/raw/orders")
    assert [r[0] for r in stored.select("_ingested_at").distinct().collect()] == [END]
    for hours, status in ((1, "WARN"), (2, "WARN"), (3, None)):
        run = DailyRun(spark, published["source"], published["root"], END + timedelta(hours=hours), land_raw=False)
        if status is None:
            with pytest.raises(GateClosed, match="stale sources 8"):
                run.judge_freshness()
        else:
            assert run.judge_freshness()["status"] == status
    assert DailyRun(spark, published["source"], published["root"] + "-none", END).judge_freshness()["status"] == "SKIPPED"


def test_a_switch_that_breaks_leaves_everything_old(published, spark, tmp_path, monkeypatch):
    """Facts and marts change together: the one file that names them all is written after the facts' own manifests."""
    from omnimart.plans import daily_run

    root = str(tmp_path / "out")
    DailyRun(spark, published["source"], root, END).run()
    first = DailyRun(spark, published["source"], root, END)
    facts, marts, switch = first.fact("fct_sales").version, first.published(), first.current()
    inner = files.publish_text

    def broken(spark, path, text):
        if "/tables/current/" in path:
            raise OSError("disk full")
        inner(spark, path, text)

    half = Changed(published["source"], "orders", lambda d: d.withColumn("ordered_at", F.col("ordered_at") + F.expr("INTERVAL 1 MINUTE")))
    monkeypatch.setattr(daily_run.files, "publish_text", broken)
    monkeypatch.setattr(daily_run.DailyRun, "pass_gate", lambda self, stage: None)
    second = DailyRun(spark, half, root, END + timedelta(hours=1), full_refresh=True)
    with pytest.raises(OSError):
        second.run()
    again = DailyRun(spark, published["source"], root, END + timedelta(hours=1))
    assert again.current() == switch and again.published() == marts and again.fact("fct_sales").version == facts
    monkeypatch.undo()
    third = DailyRun(spark, published["source"], root, END + timedelta(hours=1), full_refresh=True)
    assert third.run()["status"] == "PUBLISHED"
    assert DailyRun(spark, published["source"], root, END).fact("fct_sales").version > facts
