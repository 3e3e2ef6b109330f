"""Stored state: key index, sketches, incremental cube, digests, text index, clustered files, samples, drift."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from omnimart.operators import clustered, cube, drift, keysets, sampling, sketches, tables
from omnimart.operators.cube_store import CubeStore
from omnimart.operators.postings import MOST_VERSIONS, NullKey, PostingIndex
from omnimart.operators.trigrams import TrigramIndex

ROW = "id string, v int, at timestamp"
START = datetime(2026, 1, 1)


def read_files(df):
    return sorted(f.split("/data/")[-1].split("/part-")[0] for f in df.inputFiles())


# -- key index ---------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    return tables.KeyedTable(spark, str(tmp_path / "t"), "id", F.date_format("at", "yyyy-MM-dd"), buckets=16)


def scattered(n, days=10):
    """Keys whose order has nothing to do with their time."""
    draw = random.Random(4)
    return [(f"{draw.random()}", k, START + timedelta(days=k % days)) for k in range(n)]


def test_a_merge_reads_the_partitions_of_its_keys_only(spark, table, monkeypatch):
    rows = scattered(200)
    table.merge(spark.createDataFrame(rows, ROW), "at")
    reads = []
    inner = table._read_with_part
    monkeypatch.setattr(table, "_read_with_part", lambda parts=None, schema=None: reads.append(parts) or inner(parts, schema))
    # The smallest and the largest key, both of one day, with a newer row that stays in its day.
    batch = [(k, -1, at + timedelta(hours=1)) for k, _, at in (min(r for r in rows if r[1] % 10 == 3), max(r for r in rows if r[1] % 10 == 3))]
    table.merge(spark.createDataFrame(batch, ROW), "at")
    assert reads == [["2026-01-04"], ["2026-01-04"]]
    parts = table._manifest()["parts"]
    assert [p for p, v in parts.items() if v == 2] == ["2026-01-04"]
    found = {r.id: r.v for r in table.read().collect()}
    assert found == {k: v for k, v, _ in rows} | {k: v for k, v, _ in batch}


def test_only_touched_buckets_are_read(spark, tmp_path):
    index = PostingIndex(spark, str(tmp_path / "i"), 16)
    keys = spark.createDataFrame([(f"k{i}", f"p{i % 3}") for i in range(500)], "key string, place string")
    state = index.add(keys, {}, 1)
    assert len(state) == 16
    one = spark.createDataFrame([("k7",), ("none",)], "key string")
    buckets = index.touched(one)
    read = index._read(state, buckets, T.StringType())
    assert len(buckets) <= 2 and {f.split("_bucket=")[1].split("/")[0] for f in read.inputFiles()} <= set(buckets)
    assert [tuple(r) for r in index.find(one, state).collect()] == [("k7", "p1")]


def test_versions_of_a_bucket_are_merged_and_the_newest_place_holds(spark, tmp_path):
    index = PostingIndex(spark, str(tmp_path / "i"), 1)
    state = {}
    for version in range(1, 2 * MOST_VERSIONS + 3):
        state = index.add(spark.createDataFrame([("same", f"p{version}"), (f"k{version}", "x")], "key string, place string"), state, version)
    assert len(state["0"]) <= MOST_VERSIONS
    every = spark.createDataFrame([("same",), *((f"k{v}",) for v in range(1, 2 * MOST_VERSIONS + 3))], "key string")
    found = {r.key: r.place for r in index.find(every, state).collect()}
    assert found["same"] == f"p{2 * MOST_VERSIONS + 2}" and len(found) == 2 * MOST_VERSIONS + 3


@pytest.mark.parametrize("again", [False, True])
def test_null_keys_are_refused_and_leave_the_table(spark, table, again):
    if again:
        table.merge(spark.createDataFrame([("a", 1, START)], ROW), "at")
    with pytest.raises(NullKey):
        table.merge(spark.createDataFrame([("a", 2, START), (None, 1, START)], ROW), "at")
    assert [tuple(r)[:2] for r in table.read().collect()] == [("a", 1)] if again else not table.exists()


def test_a_table_without_an_index_gets_one(spark, tmp_path, table):
    rows = spark.createDataFrame(scattered(50), ROW)
    placed = rows.withColumn(tables.PART, table.partition)
    table.replace(placed, sorted(r[0] for r in placed.select(tables.PART).distinct().collect()))
    assert table._manifest()["index"] is None
    key = rows.first().id
    table.merge(spark.createDataFrame([(key, 999, START + timedelta(days=30))], ROW), "at")
    table.merge(spark.createDataFrame([(key, 1000, START + timedelta(days=31))], ROW), "at")
    found = {r.id: r.v for r in table.read().collect()}
    assert len(found) == 50 and table.read().count() == 50 and found[key] == 1000


def test_random_merges_equal_the_newest_row(spark, table):
    draw, expected = random.Random(9), {}
    for _ in range(6):
        batch = [(f"k{draw.randrange(30)}", draw.randrange(1000), START + timedelta(hours=draw.randrange(96))) for _ in range(25)]
        for k, v, at in batch:
            expected[k] = max(expected.get(k, (at, v)), (at, v))
        table.merge(spark.createDataFrame(batch, ROW), "at")
    assert {r.id: (r["at"], r.v) for r in table.read().collect()} == expected


# -- drift -------------------------------------------------------------------


def test_drift_kinds():
    stored = T.StructType.fromDDL("a int, b string, c decimal(12,4), d bigint, e double, f string")
    incoming = T.StructType.fromDDL("a bigint, b int, c decimal(10,2), d int, g date, f string")
    found = {name: kind for name, _, _, kind, _ in drift.changes(stored, incoming)}
    assert found == {"a": "widened", "b": "retyped", "c": "narrowed", "d": "narrowed", "e": "removed", "f": "same", "g": "added"}
    assert drift.merged_schema(stored, incoming) is None


def test_drift_decides_the_merge(spark, table):
    table.merge(spark.createDataFrame([("a", 1, START), ("b", 2, START + timedelta(days=1))], ROW), "at")
    wider = spark.createDataFrame([("a", 2**40, START + timedelta(hours=1), "new")], "id string, v bigint, at timestamp, note string")
    with pytest.raises(tables.SchemaDrift):
        table.merge(wider, "at")
    table.merge(wider, "at", evolve=True)
    # The other day's file still holds the narrow type and no note.
    assert sorted(tuple(r)[:2] + (r.note,) for r in table.read().collect()) == [("a", 2**40, "new"), ("b", 2, None)]
    table.merge(spark.createDataFrame([("c", 3, START)], ROW), "at", evolve=True)
    assert {r.id: r.v for r in table.read().collect()} == {"a": 2**40, "b": 2, "c": 3}
    with pytest.raises(tables.SchemaDrift):
        table.merge(spark.createDataFrame([("a", "x", START)], "id string, v string, at timestamp"), "at", evolve=True)


# -- sketches ----------------------------------------------------------------

SALE = "order_id string, channel string, customer_id string, sales_amount decimal(18,2), quantity int, ordered_at timestamp"
AS_OF = datetime(2026, 3, 1, 6)


def sales_rows(n, seed, customers=5000):
    draw = random.Random(seed)
    return [
        (f"o{k}", draw.choice(("web", "store", "marketplace")), f"c{draw.randrange(customers)}", Decimal(draw.randrange(10_000)) / 100, draw.randrange(4), AS_OF - timedelta(minutes=draw.randrange(1, 45 * 1440)))
        for k in range(n)
    ]


def test_customers_of_any_period_from_daily_sketches(spark):
    sales = spark.createDataFrame(sales_rows(30_000, 1), SALE)
    daily = sketches.daily_sales(sales, AS_OF)
    exact = {(r.channel, r.period): r for r in cube.sales_cube(sales, AS_OF).collect()}
    for r in sketches.period_cells(daily).collect():
        cell = exact[r.channel, r.period]
        assert (r.revenue, r.orders, r.units) == (cell.revenue, cell.orders, cell.units)
        assert abs(r.customers - cell.customers) <= 4 * sketches.STANDARD_ERROR * cell.customers
    # The same rows at an earlier moment.
    exact = {(r.channel, r.period): r.orders for r in cube.sales_cube(sales.filter(F.col("ordered_at") < AS_OF - timedelta(days=3)), AS_OF - timedelta(days=3)).collect()}
    assert {(r.channel, r.period): r.orders for r in sketches.period_cells(daily.filter("day < -3"), -3).collect()} == exact


def test_quantiles_of_any_period_from_minute_sketches(spark):
    draw = random.Random(2)
    rows = [("a" if k % 3 else "b", START + timedelta(seconds=k), int(draw.expovariate(0.01))) for k in range(20_000)] + [("a", START, None)]
    events = spark.createDataFrame(rows, "event_type string, event_at timestamp, latency_ms int")
    minutes = sketches.latency_sketches(events)
    for part in (F.lit(True), F.col("minute") >= START + timedelta(hours=2)):
        chosen = minutes.filter(part)
        estimated = sketches.sketched_quantile(chosen, 0.95)
        near = events.withColumn("minute", F.date_trunc("minute", "event_at")).filter(part)
        found = sketches.rank_within(near, "latency_ms", estimated, "percentile", 0.95, ["event_type"]).collect()
        assert len(found) == 2 and all(r.within for r in found)
        assert {r.event_type: r.row_count for r in estimated.collect()} == {r.event_type: r.n for r in near.groupBy("event_type").agg(F.count("latency_ms").alias("n")).collect()}


# -- cube --------------------------------------------------------------------


def cells(df):
    return sorted(map(tuple, df.select("channel", "period", "revenue", "orders", "customers", "units", "avg_basket").collect()))


def test_cube_follows_corrections_and_new_days(spark, tmp_path):
    rows, store = sales_rows(3000, 3, 200), CubeStore(spark, str(tmp_path / "c"))
    for days in (9, 8, 3, 0):
        as_of = AS_OF - timedelta(days=days)
        known = spark.createDataFrame([r for r in rows if r[-1] < as_of], SALE)
        changed = set()
        if days != 9:
            # Two days are corrected: other amounts, one order gone, one for a customer of its own.
            for back in (days + 2, days + 12):
                day = store.day_of(AS_OF) - back
                own = [k for k, r in enumerate(rows) if int((r[-1] - datetime(1970, 1, 1, 6)).total_seconds() // 86400) == day]
                rows = [(*r[:3], r[3] + 1, r[4] + 1, r[5]) if k in own else r for k, r in enumerate(rows) if k != own[0]]
                rows.append((f"late{days}", "web", f"new{back}", Decimal("5.00"), 1, datetime(1970, 1, 1, 7) + timedelta(days=day)))
                changed.add(day)
            known = spark.createDataFrame([r for r in rows if r[-1] < as_of], SALE)
        store.advance(known, as_of, changed)
        assert cells(store.read()) == cells(cube.sales_cube(known, as_of))


def test_an_advance_reads_changed_days_only(spark, tmp_path, plan, monkeypatch):
    rows, store = sales_rows(2000, 5, 100), CubeStore(spark, str(tmp_path / "c"))
    path = str(tmp_path / "sales")
    spark.createDataFrame([r for r in rows if r[-1] < AS_OF], SALE).write.parquet(path)
    store.advance(spark.read.parquet(path), AS_OF - timedelta(days=1))
    asked, inner = [], store._daily
    monkeypatch.setattr(store, "_daily", lambda days: asked.append(sorted(map(int, days))) or inner(days))
    today = store.day_of(AS_OF)
    store.advance(spark.read.parquet(path), AS_OF, {today - 5})
    # Each period takes back the day that leaves it and the corrected one, and adds the corrected one and the one that is over.
    assert asked == [d for p in (7, 14, 30) for d in ([today - 1 - p, today - 5, today - 1], [today - 5, today - 1])]
    # A day without sales has no folder.
    assert store.manifest()["days"][str(today)] is None


def test_days_that_change_at_another_time_are_refused(spark, tmp_path):
    store, sales = CubeStore(spark, str(tmp_path / "c")), spark.createDataFrame(sales_rows(10, 1), SALE)
    store.advance(sales, AS_OF)
    with pytest.raises(ValueError):
        store.advance(sales, AS_OF + timedelta(hours=1))


# -- digests -----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_digest_comparison_equals_the_full_one(spark, seed):
    draw = random.Random(seed)
    keys = [f"k{i}" for i in range(3000)] + ["k5", "k5", None]
    a = spark.createDataFrame([(k,) for k in keys if k is None or draw.random() > 0.01], "x string")
    b = spark.createDataFrame([(k,) for k in keys if draw.random() > 0.01], "y string")
    found = keysets.key_differences_by_digest(a, "x", b, "y", 4096)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, keysets.key_differences(a, "x", b, "y").collect()), key=str)


def test_equal_ranges_are_not_compared(spark):
    a = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    found = keysets.key_differences_by_digest(a, "k", a.filter("id <> 77"), "k", 512)
    assert [tuple(r) for r in found.collect()] == [("77", "left")]
    differing = keysets.digests(a, "k", 512).join(keysets.digests(a.filter("k <> '77'"), "k", 512), ["range", "n", "digest"], "left_anti")
    assert differing.count() == 1


# -- text index --------------------------------------------------------------

TEXTS = [(1, "Robe Bleue", "WEB"), (2, "robe rouge", None), (3, "Éclair au café", "Store"), (4, "", ""), (5, "a", "b"), (6, "100% laine_", "x.y"), (7, "bleu de travail", "web")]


@pytest.mark.parametrize("text", ["robe", " BLEU ", "e r", "café", "é", "%", "a b", "zzz", "", "  ", "x.y", "b", "ro", "robe bleue web", "laine_"])
def test_index_finds_what_the_scan_finds(spark, tmp_path, text):
    rows = spark.createDataFrame(TEXTS, "id int, name string, channel string")
    index = TrigramIndex(spark, str(tmp_path / "i"), 4)
    index.build(rows, "id", ["name", "channel"])
    expected = [r.id for r in keysets.search_rows(rows, ["name", "channel"], text).collect()]
    assert sorted(r.id for r in index.search(text).collect()) == sorted(expected)


def test_search_reads_the_buckets_of_the_rarest_runs(spark, tmp_path, plan):
    rows = spark.range(2000).select("id", F.concat(F.lit("common text "), F.when(F.col("id") == 7, "needle").otherwise("hay")).alias("t"))
    index = TrigramIndex(spark, str(tmp_path / "i"), 32)
    index.build(rows, "id", ["t"])
    rarest = index.rarest("text needle")
    assert all(run in "t needle" for run, _ in rarest)
    candidates = index.candidates("text needle")
    assert [r.id for r in candidates.collect()] == [7]
    assert "PartitionFilters: [bucket" in plan(candidates).replace("isnotnull(bucket), ", "")


# -- clustered files ---------------------------------------------------------


def test_a_day_is_read_from_its_own_files(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(k, START + timedelta(hours=k)) for k in range(24 * 40)] + [(9000 + k, START + timedelta(days=20)) for k in range(900)] + [(1, None)]
    clustered.write_clustered(spark.createDataFrame(rows, "id int, at timestamp"), path, "at", 16)
    low, high = START + timedelta(days=5), START + timedelta(days=6)
    day = clustered.read_between(spark, path, "at", low, high)
    assert sorted(r.id for r in day.collect()) == list(range(120, 144))
    assert 1 <= len(day.inputFiles()) <= 2 < len(clustered.bounds(spark, path).collect())
    # A moment that half of the rows share is spread over several files.
    hot = START + timedelta(days=20)
    assert len(clustered.files_between(spark, path, hot, hot + timedelta(seconds=1))) >= 5
    assert clustered.read_between(spark, path, "at", hot, hot + timedelta(seconds=1)).count() == 901
    assert clustered.read_between(spark, path, "at", START - timedelta(days=9), START).collect() == []
    assert sum(r.n for r in clustered.bounds(spark, path).collect()) == len(rows)


# -- samples -----------------------------------------------------------------


def test_samples_do_not_depend_on_the_partitioning(spark):
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("g"), "id")
    one = {r.k: r.sample_rank for r in sampling.bottom_k(rows.repartition(1), ["k"], 10).collect()}
    many = {r.k: r.sample_rank for r in sampling.bottom_k(rows.repartition(13, "g").orderBy(F.desc("id")), ["k"], 10).collect()}
    assert one == many and sorted(one.values()) == list(range(1, 11))
    groups = Counter(r.g for r in sampling.bottom_k(rows, ["k"], 4, by=["g"]).collect())
    assert groups == {0: 4, 1: 4, 2: 4}


def test_landing_report(spark):
    rows = spark.createDataFrame([(START + timedelta(seconds=k), k) for k in range(1, 21)] + [(None, None)], "at timestamp, ms int")
    report = sampling.landing_report("events", rows, "at", "ms").first()
    assert tuple(report) == ("events", 21, START + timedelta(seconds=1), START + timedelta(seconds=20), 19)
    empty = sampling.landing_report("none", rows.limit(0)).first()
    assert tuple(empty) == ("none", 0, None, None, None)


def test_every_model_is_a_view(spark):
    from omnimart.plans.warehouse import MODELS, Warehouse
    from omnimart.sources.star import StarSource

    names = Warehouse(StarSource(spark, "/root/testdata/sf0.001")).register_views("w_")
    assert names == [f"w_{m}" for m in MODELS]
    paid = spark.sql("SELECT count(*) FROM w_fct_sales s JOIN w_payment_reconciliation p USING (order_id)").first()[0]
    assert paid >= spark.table("w_fct_sales").count() > 0
