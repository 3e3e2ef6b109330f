"""Registered queries over stored state: settled streams, key indexes, sketches, incremental cube, drift, samples."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from omnimart.functions.scalars import moment
from omnimart.operators import checks, clustered, cube, drift, files, keysets, sampling, sketches, tables
from omnimart.operators.cube_store import CubeStore
from omnimart.operators.quantiles import nearest_rank
from omnimart.operators.trigrams import TrigramIndex
from omnimart.plans import contracts, core, marts, quality, reports, staging
from omnimart.plans.catalogue import AS_OF, EXPORT_COLUMNS, LOADED, LOADED_ELSE, Model, _scratch, _stock, query
from omnimart.plans.daily_run import DailyRun, GateClosed, run_evidence
from omnimart.session import CODEC, pin
from omnimart.sources.landing import LandingSource
from omnimart.sources.schemas import SOURCE_NAMES, file_of
from omnimart.streaming import events as stream_events, matching, resends, sinks, windows

# -- settled streams ---------------------------------------------------------

#: Files of a feed, and how many arrive in a micro-batch.
FEED_FILES, FILES_A_BATCH = 8, 2


def _feed(m: Model, rows: DataFrame, arrival: Column, name: str) -> DataFrame:
    """Rows as a stream of several files in the order of ``arrival``."""
    folder = f"{_scratch(m, name)}/in"
    placed = rows.withColumn("_arrival", arrival)
    placed.repartitionByRange(FEED_FILES, "_arrival").drop("_arrival").write.option("compression", CODEC).parquet(folder)
    return stream_events.read_event_files(m.source.spark, folder, rows.schema, max_files=FILES_A_BATCH)


def _delayed(time: str, key: str, days: int = 60) -> Column:
    """Arrival by time; of every twentieth key some months late."""
    late = F.pmod(F.xxhash64(key), F.lit(20)) == 0
    return F.unix_micros(time) + F.when(late, days * 86_400_000_000).otherwise(0)


@query
def stream_full_outer(m: Model) -> DataFrame:
    """Sales and purchase events joined as two streams; what does not agree or has no partner.

    Some rows arrive months late on either side; open state and late rows complete the comparison.
    """
    sales = m.sales("quantity", "ordered_at").select("order_id", F.col("ordered_at").alias("at"), "quantity")
    purchases = m.events("event_type", "order_id", "quantity", "event_at").filter("event_type = 'purchase'")
    events = purchases.select("order_id", F.col("event_at").alias("at"), "quantity")
    left = _feed(m, sales, _delayed("at", "order_id"), "sales-feed")
    right = _feed(m, events, _delayed("at", "order_id", 90), "purchase-feed")
    run = matching.compare_streams(left, right, _scratch(m, "compared"))
    found = matching.mismatches(matching.settled_pairs(run))
    return found.withColumns({c: F.col(c).cast("double") for c in ("batch_quantity", "stream_quantity")})


def _latency_run(m: Model):
    events = staging.typed_events(m.source.table("retail_events")).select("event_id", "event_at", "latency_ms")
    feed = _feed(m, events, _delayed("event_at", "event_id"), "latency-feed")
    return windows.count_latencies(feed, _scratch(m, "latency-run"))


@query
def stream_windows_settled(m: Model) -> DataFrame:
    """Minutes of a stream some of whose events arrive months late: emitted, open and late parts together."""
    return windows.latency_of(windows.parts(_latency_run(m)))


@query
def stream_rows_accounted(m: Model) -> DataFrame:
    """Events of the parts of a settled run by hour; none is lost and none counted twice."""
    counters = windows.parts(_latency_run(m))
    return counters.groupBy(F.date_trunc("hour", "window_start").alias("hour")).agg(
        F.sum("n").alias("events"), F.sum(F.col("n") * F.col("latency_ms")).alias("latency_ms")
    )


@query
def retail_stream_alarm(m: Model) -> DataFrame:
    """Alarm minutes over purchase and web events, late ones included."""
    return stream_events.alarms(windows.latency_of(windows.parts(_latency_run(m))))


@query
def stream_dedup_ever(m: Model) -> DataFrame:
    """Whole rows of events, each once; every tenth number is sent again twice, hours and months later."""
    events = staging.stg_retail_events(m.source)
    number = F.split_part("event_id", F.lit("-"), F.lit(2)).cast("bigint")
    hours = F.when(number % 10 == 0, F.array(*map(F.lit, (0, 2, 2000)))).otherwise(F.array(F.lit(0)))
    sent = events.withColumn("_after", F.explode(hours))
    arrival = _delayed("event_at", "event_id") + F.col("_after") * 3_600_000_000
    folder = f"{_scratch(m, 'resend-feed')}/in"
    sent.withColumn("_arrival", arrival).repartitionByRange(FEED_FILES, "_arrival").drop("_arrival", "_after").write.option("compression", CODEC).parquet(folder)
    feed = stream_events.read_event_files(m.source.spark, folder, events.schema, max_files=FILES_A_BATCH)
    return resends.events_once(resends.deduplicate_ever(feed, _scratch(m, "dedup-ever")))


# -- state that adds up ------------------------------------------------------


@query
def customers_by_sketch(m: Model) -> DataFrame:
    """Cells from daily sketches next to exact customers: whether the estimate is within four standard errors."""
    sales = m.sales("channel", "quantity", "sales_amount", "ordered_at")
    start = moment(AS_OF - timedelta(days=max(cube.PERIODS)))
    daily = sketches.daily_sales(sales.filter(F.col("ordered_at") >= start), AS_OF)
    path = _scratch(m, "daily-sketches")
    daily.write.partitionBy("day").parquet(path)
    cells = sketches.period_cells(m.source.spark.read.parquet(path)).withColumnRenamed("customers", "estimate")
    exact = cube.sales_cube(sales, AS_OF).select("channel", "period", "customers")
    within = F.abs(F.col("estimate") - F.col("customers")) <= F.ceil(4 * sketches.STANDARD_ERROR * F.col("customers"))
    return cells.join(exact, ["channel", "period"]).select("channel", "period", "revenue", "orders", "units", "customers", within.alias("within"))


@query
def latency_p95_by_sketch(m: Model) -> DataFrame:
    """95th percentile by event type from minute sketches next to the exact one: whether it is within the rank error."""
    events = staging.typed_events(m.source.table("retail_events")).select("event_type", "event_at", "latency_ms")
    path = _scratch(m, "minute-sketches")
    sketches.latency_sketches(events).write.parquet(path)
    estimated = sketches.sketched_quantile(m.source.spark.read.parquet(path), 0.95, name="estimate")
    exact = nearest_rank(events, "latency_ms", 0.95, ["event_type"], "latency_p95_ms")
    within = sketches.rank_within(events, "latency_ms", estimated, "estimate", 0.95, ["event_type"])
    return exact.join(estimated.select("event_type", F.col("row_count").alias("sketched")), "event_type").join(within, "event_type").select("event_type", "row_count", "sketched", "latency_p95_ms", "within")


@query
def cube_advanced(m: Model) -> DataFrame:
    """The cube of a day kept up to date: stored the day before, then two earlier days corrected and a day added."""
    sales = m.sales("channel", "quantity", "sales_amount", "ordered_at")
    number = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint")
    day = F.to_date("ordered_at").cast("string")
    wrong = (number % 3 == 0) & day.isin("2001-10-12", "2001-11-01")
    former = sales.filter(F.col("ordered_at") < moment(AS_OF - timedelta(days=1))).withColumns(
        {"quantity": F.col("quantity") + F.when(wrong, 5).otherwise(0), "channel": F.when(wrong, "web").otherwise(F.col("channel"))}
    )
    store = CubeStore(m.source.spark, _scratch(m, "cube-store"))
    store.advance(former, AS_OF - timedelta(days=1))
    # A calendar day lies in two of the store's days, which change at the time of the report.
    corrected = {store.day_of(d) - k for d in (datetime(2001, 10, 12), datetime(2001, 11, 1)) for k in (0, 1)}
    store.advance(sales, AS_OF, corrected)
    return store.read()


@query
def key_difference_by_digest(m: Model) -> DataFrame:
    """Orders without a payment and payments without an order, comparing differing hash ranges only."""
    orders, payments = staging.stg_orders(m.source, wanted=()), m.payments("order_id")
    return keysets.key_differences_by_digest(orders, "order_id", payments, "order_id")


# Texts that are looked for.
SEARCHED = (" Size 1", "small", "LARGE ANODIZED", "zz", "7", "ck", "brushed tin", "%")


@query
def text_search_indexed(m: Model) -> DataFrame:
    """Products that contain a text, by the trigram index."""
    index = TrigramIndex(m.source.spark, _scratch(m, "trigrams"))
    index.build(m.products(), "product_id", ["product_name", "category", "collection_name"])
    found = [index.search(t).select(F.lit(t).alias("text"), F.col("id").alias("product_id")) for t in SEARCHED]
    return reduce(DataFrame.unionByName, found)


# -- layouts, samples, drift -------------------------------------------------


@query
def clustered_days(m: Model) -> DataFrame:
    """Orders written in the order of time; three days read back, each from the files that may hold it."""
    spark, path = m.source.spark, _scratch(m, "clustered")
    orders = staging.typed_orders(m.source.table("orders"))
    clustered.write_clustered(orders, path, "ordered_at", 32)
    files = clustered.bounds(spark, path).count()
    days = []
    for day in (datetime(1999, 3, 4), datetime(2000, 2, 29), datetime(2001, 11, 1)):
        rows = clustered.read_between(spark, path, "ordered_at", day, day + timedelta(days=1))
        few = len(clustered.files_between(spark, path, day, day + timedelta(days=1))) <= max(2, files // 8)
        days.append(rows.agg(F.count("*").alias("orders"), F.sum("quantity").alias("units")).select(F.lit(f"{day:%Y-%m-%d}").alias("day"), "orders", "units", F.lit(few).alias("few_files")))
    return reduce(DataFrame.unionByName, days)


# The columns that name a row of each source.
SAMPLE_KEYS = {
    "products": ("product_id",),
    "customers": ("customer_id",),
    "customer_identities": ("source_system", "source_customer_id"),
    "inventory": ("product_id",),
    "orders": ("order_id",),
    "payments": ("transaction_id",),
    "retail_events": ("event_id",),
    "price_history": ("product_id", "valid_from"),
}


def _raw_zone(m: Model) -> dict[str, DataFrame]:
    root, day = _scratch(m, "raw-reported"), "2001-11-05"
    folders = {n: tables.write_raw_zone(m.source.table(n), root, n, day) for n in SOURCE_NAMES}
    return {n: m.source.spark.read.parquet(f).drop("ingestion_date") for n, f in folders.items()}


@query
def landing_samples(m: Model) -> DataFrame:
    """Ten rows of each landed source, the same ones on every run."""
    parts = []
    for name, landed in _raw_zone(m).items():
        columns = SAMPLE_KEYS[name]
        found = sampling.bottom_k(landed, columns, 10)
        parts.append(found.select(F.lit(name).alias("source"), "sample_rank", F.concat_ws("|", *(F.col(c).cast("string") for c in columns)).alias("sample_key"), "sample_hash"))
    return reduce(DataFrame.unionByName, parts)


# Time of the sources that have one.
LANDED_TIMES = {"orders": "ordered_at", "payments": "paid_at", "retail_events": "event_at"}


@query
def landing_reports(m: Model) -> DataFrame:
    """Rows, time span and latency of each landed source."""
    parts = [
        sampling.landing_report(name, landed, LANDED_TIMES.get(name), "latency_ms" if name == "retail_events" else None)
        for name, landed in _raw_zone(m).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def drift_merge(m: Model) -> DataFrame:
    """Payments of two deliveries, the second with other columns and types: the drift report, and the values after the merge.

    The second has wider amounts, no currency and a column more; the report accepts that, so the merge takes it over.
    """
    spark = m.source.spark
    payments = staging.stg_payments(m.source).withColumn("attempts", F.lit(1))
    half = F.split_part("transaction_id", F.lit("-"), F.lit(2)).cast("bigint") % 2
    first = payments.filter(half == 0)
    second = payments.filter(half == 1).withColumns(
        {"amount": F.col("amount").cast("decimal(20,2)"), "attempts": F.col("attempts").cast("bigint"), "terminal": F.col("payment_method")}
    ).drop("currency")
    table = tables.KeyedTable(spark, _scratch(m, "drifting"), "transaction_id", F.date_format("paid_at", "yyyy-MM"))
    table.merge(first, "paid_at")
    report = drift.drift_report(spark, first.schema, second.schema)
    table.merge(second, "paid_at", evolve=True)
    after = table.read()
    counts = after.agg(*(F.count(c).alias(c) for c in after.columns))
    filled = counts.unpivot([], after.columns, "column", "values")
    return report.join(filled, "column")


# -- landing, exports, publication -------------------------------------------


@query
def csv_landing_quoted(m: Model) -> DataFrame:
    """Products whose names hold a line break and quotes, written as CSV and read back; none is damaged."""
    folder = _scratch(m, "landing-quoted")
    first = F.split_part("name", F.lit(" "), F.lit(1))
    name = F.concat(first, F.lit('\n"'), F.col("product_id"), F.lit('", two'))
    rows = m.source.table("products").withColumn("name", name)
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/{file_of('products')}")
    source = LandingSource(m.source.spark, folder)
    damaged = source.quarantine("products").agg(F.count("*")).scalar()
    return source.table("products").select("product_id", "name", "category", "price", damaged.alias("damaged"))


@query
def freshness_stored(m: Model) -> DataFrame:
    """Age of each source by the load times stored with its rows in the raw zone; three sources were loaded twice."""
    root, spark = _scratch(m, "raw-stamped"), m.source.spark
    given = {name: m.source.table(name) for name in SOURCE_NAMES}
    for name in SOURCE_NAMES:
        first = LOADED[name] if name == "price_history" else LOADED_ELSE
        tables.write_raw_zone(given[name], root, name, "2001-11-04", first)
    for name in (n for n in LOADED if n != "price_history"):
        # The same rows, read from where they landed first.
        again = tables.landed_day(given[name], root, name, "2001-11-04")
        tables.write_raw_zone(again, root, name, "2001-11-05", LOADED[name])
    loaded = {n: spark.read.parquet(f"{root}/raw/{n}") for n in SOURCE_NAMES}
    return quality.freshness(loaded, tables.LOADED_AT, AS_OF)


@query
def csv_export_files(m: Model) -> DataFrame:
    """Lines of the stock export as whole files of a hundred rows, each under its heading."""
    path = _scratch(m, "export-files")
    tables.write_export(_stock(m), path, EXPORT_COLUMNS, [F.col("product_id")], rows_per_file=100)
    return m.source.spark.read.text(path).select("file", F.col("value").alias("line"))


@query
def kpi_record_scored(m: Model) -> DataFrame:
    """The KPI record with the score of the contracts."""
    # Stored for the contracts, and read again for the facts.
    raw = contracts.stored(staging.typed_sources(m.source), "orders", "retail_events", "payments", more={"retail_events": ("channel", "latency_ms")})
    score = checks.score(contracts.as_check_results(contracts.run_contracts(raw, AS_OF))).first()["score"]
    bridge = m.bridge()
    orders = staging.latest_orders(raw["orders"], ("product_id", "sales_amount", "source_customer_id"))
    sales = pin(core.fct_sales(orders, bridge).select("customer_id", "product_id", "quantity", "sales_amount"), "sales")
    events = core.fct_retail_event(staging.latest_events(raw["retail_events"], ("latency_ms", "source_customer_id")), bridge)
    available = marts.available_to_promise(m.inventory(), sales)
    return reports.kpi_record(sales, m.products(), events, available, score)


@query
def top_departments(m: Model) -> DataFrame:
    """The seven best of more departments than that."""
    products = m.products().withColumn("category", F.col("department"))
    return reports.top_categories(m.selected("product_id", "sales_amount"), products)


@query
def lost_fact_rows(m: Model) -> DataFrame:
    """Rows without a customer by fact, and whether the strict lookup refuses the fact."""
    spark, parts = m.source.spark, []
    staged = {"fct_sales": staging.stg_orders(m.source, wanted=("source_customer_id",)), "fct_retail_event": staging.stg_retail_events(m.source, wanted=("source_customer_id",))}
    bridge = pin(m.bridge(), "bridge")
    for name, rows in staged.items():
        rows = pin(rows.select("source_customer_id"), "customers-of-rows")
        try:
            core.require_resolved(rows, bridge)
            refused = False
        except LookupError:
            refused = True
        lost = core.unresolved(rows, bridge).agg(F.count("*").alias("lost"))
        parts.append(lost.select(F.lit(name).alias("fact"), "lost", F.lit(refused).alias("refused")))
    return reduce(DataFrame.unionByName, parts)


STRICT_FROM = datetime(2000, 1, 1)


@query
def stream_strict_merge(m: Model) -> DataFrame:
    """Events merged by the strict rule: of those that come behind the stored maximum, none arrives."""
    spark, folder = m.source.spark, _scratch(m, "strict")
    # Stored once for both deliveries.
    events = pin(staging.stg_retail_events(m.source), "events")
    number = F.split_part("event_id", F.lit("-"), F.lit(2)).cast("bigint")
    early = (F.col("event_at") < moment(STRICT_FROM)) & (number % 20 != 0)
    table = tables.KeyedTable(spark, f"{folder}/fact", "event_id", F.date_format("event_at", "yyyy-MM"))
    for rows in (events.filter(early), events.filter(~early)):
        rows.write.mode("append").option("compression", CODEC).parquet(f"{folder}/in")
        stream = stream_events.read_event_files(spark, f"{folder}/in", events.schema)
        sinks.run_available(stream, f"{folder}/checkpoint", sinks.merge_into(table, "event_at", strict=True))
    return table.read()


def _closed_run(m: Model) -> str:
    """Folder of a daily run over the mapped sources, whose deliberate gaps close the gate."""
    root = _scratch(m, "daily-run")
    try:
        DailyRun(m.source.spark, m.source, root, AS_OF, land_raw=False).run()
    except GateClosed:
        pass  # what was found stands in the reports
    return root


@query
def gate_table(m: Model) -> DataFrame:
    """Findings of a daily run up to the gate that closed."""
    report = files.read_json(m.source.spark, f"{_closed_run(m)}/reports/gates.json")
    rows = [(g["stage"], g["finding"], g["value"], g["limit"], g["passed"], report["status"]) for g in report["gates"]]
    return m.source.spark.createDataFrame(rows, "stage string, finding string, value double, limit double, passed boolean, status string")


@query
def run_evidence_steps(m: Model) -> DataFrame:
    """State of each step of that run, and the records it counted."""
    found = run_evidence(m.source.spark, _closed_run(m))
    rows = [(step, state, found["source_records"], found["publishable"]) for step, state in found["steps"].items()]
    return m.source.spark.createDataFrame(rows, "step string, state string, source_records bigint, publishable boolean")
