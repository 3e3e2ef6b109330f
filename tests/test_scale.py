"""Large sources are made, shuffled and stored no more than their queries need."""

from collections import Counter

import pytest

from omnimart.operators import files
from omnimart.plans import catalogue, quality, staging
from omnimart.plans.warehouse import Warehouse
from omnimart.sources.star import StarSource
from omnimart.streaming import sinks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def made(monkeypatch):
    """How often each source was made."""
    counts, table = Counter(), StarSource.table

    def counted(self, name, since=None):
        counts[name] += 1
        return table(self, name, since)

    monkeypatch.setattr(StarSource, "table", counted)
    return counts


def test_order_lines_are_joined_without_their_texts(spark):
    plan = StarSource(spark, FOLDER).table("orders")._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan[plan.index("Join Inner"):]


@pytest.mark.parametrize("name", ["raw_zone_all_sources", "freshness_stored"])
def test_a_source_is_made_once_for_all_its_landings(spark, made, name):
    assert catalogue.QUERIES[name](spark, FOLDER).count()
    assert max(made.values()) == 1


def test_checked_models_are_cut_to_what_is_read(spark):
    source = StarSource(spark, FOLDER)
    whole, cut = Warehouse(source), Warehouse(source, quality.USED)
    for name, columns in quality.USED.items():
        assert cut[name].columns == list(columns)
        assert sorted(map(str, cut[name].collect())) == sorted(map(str, whole[name].select(*columns).collect()))


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


@pytest.mark.parametrize("name, method", [("corrections_out_of_order", "merge"), ("stream_strict_merge", None)])
def test_batches_of_a_table_read_stored_rows(spark, monkeypatch, name, method):
    from omnimart.operators.tables import KeyedTable

    found, merge = [], KeyedTable.merge

    def seen(self, batch, time, evolve=False):
        found.append(joins(batch))
        return merge(self, batch, time, evolve)

    if method:
        monkeypatch.setattr(KeyedTable, method, seen)
        catalogue.QUERIES[name](spark, FOLDER)
        assert found and not any(found)
        return
    calls, stage = [], staging.stg_retail_events
    monkeypatch.setattr(staging, "stg_retail_events", lambda *a, **k: calls.append(stage(*a, **k)) or calls[-1])
    pinned, pin = [], catalogue.catalogue_state.pin
    monkeypatch.setattr(catalogue.catalogue_state, "pin", lambda df, n: pinned.append(n) or pin(df, n))
    catalogue.QUERIES[name](spark, FOLDER)
    assert len(calls) == 1 and "events" in pinned


def test_lost_rows_are_looked_up_in_stored_ids(spark, monkeypatch):
    from omnimart.plans import core

    found, unresolved = [], core.unresolved
    monkeypatch.setattr(core, "unresolved", lambda rows, bridge: found.append((rows.columns, joins(rows))) or unresolved(rows, bridge))
    assert catalogue.QUERIES["lost_fact_rows"](spark, FOLDER).count() == 2
    assert len(found) == 4 and all(f == (["source_customer_id"], 0) for f in found)


def test_event_lines_are_packed(spark, tmp_path):
    rows = [(f"k{k % 3}", f'{{"n": {k}}}') for k in range(1200)]
    sinks.write_json_lines(spark.createDataFrame(rows, "key string, value string"), str(tmp_path / "lines"), 1)
    parts = list((tmp_path / "lines").glob("part-*"))
    assert parts and all(p.name.endswith(".gz") for p in parts)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "lines")).collect()) == sorted(v for _, v in rows)


def test_landing_files_stay_below_what_a_task_reads(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "LANDING_RECORDS", 100)
    folder = catalogue._landed(catalogue.Model(StarSource(spark, FOLDER)))
    whole = StarSource(spark, FOLDER).table("payments").count()
    assert len([f for f in files.children(spark, f"{folder}/payments.csv") if f.startswith("part-")]) >= whole // 100


def test_added_fields_follow_without_a_second_map(spark):
    """The text is that of a map with the two fields at its end."""
    from pyspark.sql import functions as F
    from omnimart.streaming import validation

    texts = ['{"event_id":"a","n":1.50,"s":"x\\"y","o":{"b":[1,null]}}', '{"schema_version":"old","event_id":null,"idempotency_key":7}', '{"schema_version":"old"}', "{}", '{"event_id":{"k":"é"},"n":null,"n":2}', None, "[1]"]
    fields = spark.createDataFrame([(t,) for t in texts], "t string").select("t", validation.payload_fields(F.col("t")).alias("f"))
    kept = F.filter(F.map_entries("f"), lambda entry: ~entry["key"].isin(*validation.ADDED))
    version = F.struct(F.lit(validation.ADDED[0]).alias("key"), F.parse_json(F.lit(f'"{validation.SCHEMA_VERSION}"')).alias("value"))
    key = F.struct(F.lit(validation.ADDED[1]).alias("key"), F.col("f")["event_id"].alias("value"))
    plain = F.to_json(F.map_from_entries(F.concat(kept, F.array(version, key))))
    for row in fields.select("t", validation.enriched_json(F.col("f")).alias("found"), plain.alias("plain")).collect():
        assert row.found == row.plain, row.t
    added = validation.enriched_json(F.col("f"))._jc.toString()
    assert added.count("to_json") == 2 and "parse_json" not in added


def test_routing_stores_a_batch_instead_of_keeping_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: pytest.fail("kept in memory"))
    rows = spark.createDataFrame([("a", "Ok", "x"), ("b", "ProcessingFailed", "y")], "recordId string, result string, data string")
    sinks.route_validated(str(tmp_path / "good"), str(tmp_path / "failed"))(rows, 0)
    assert [r.recordId for r in spark.read.parquet(str(tmp_path / "good")).collect()] == ["a"]
    assert [r.recordId for r in spark.read.parquet(str(tmp_path / "failed")).collect()] == ["b"]


def pins(monkeypatch, module):
    names, pin = [], module.pin
    monkeypatch.setattr(module, "pin", lambda df, name: names.append(name) or pin(df, name))
    return names


def test_first_rows_of_a_table_are_written_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from omnimart.operators import tables

    names = pins(monkeypatch, tables)
    table = tables.KeyedTable(spark, str(tmp_path / "t"), "id", F.col("day"))
    empty = spark.createDataFrame([], "id string, day string, at timestamp, v int")
    table.merge(empty, "at")
    assert not table.exists()
    with pytest.raises(ValueError):
        table.merge(spark.sql("SELECT CAST(null AS STRING) AS id, 'a' AS day, timestamp'2026-01-01' AS at, 1 AS v"), "at")
    with pytest.raises(ValueError):
        table.merge(spark.sql("SELECT '1' AS id, 'a/=b' AS day, timestamp'2026-01-01' AS at, 1 AS v"), "at")
    assert not table.exists()
    rows = "VALUES ('1', 'a', 1), ('1', 'b', 2), ('2', 'b', 3), ('3', null, 4)"
    first = spark.sql(f"SELECT col1 AS id, col2 AS day, timestamp_seconds(col3) AS at, col3 AS v FROM ({rows})")
    table.merge(first, "at")
    assert not names
    table.merge(first.filter("id = '2'").withColumn("day", F.lit("c")).withColumn("v", F.lit(9)).withColumn("at", F.timestamp_seconds(F.lit(9))), "at")
    assert sorted(r.v for r in table.read().collect()) == [2, 4, 9]


def test_events_told_apart_are_written_once(spark, monkeypatch):
    from omnimart.streaming import resends

    names = pins(monkeypatch, resends)
    found = catalogue.QUERIES["stream_dedup_ever"](spark, FOLDER)
    assert set(names) == {"once"}
    assert found.count() == found.select("event_id").distinct().count() == catalogue.QUERIES["stg_events_dedup"](spark, FOLDER).count()


def test_contracts_and_kpis_read_the_same_stored_sources(spark, made):
    assert catalogue.QUERIES["kpi_record_scored"](spark, FOLDER).count() == 1
    assert made["orders"] == made["retail_events"] == made["payments"] == 1
