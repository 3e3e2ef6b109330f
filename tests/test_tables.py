from datetime import datetime

import pytest
from pyspark.sql import functions as F

from omnimart.operators import files, tables
from omnimart.operators.snapshot import Snapshot
from omnimart.sources.landing import LandingSource, MissingSources
from omnimart.sources.schemas import SOURCE_NAMES
from omnimart.sources.synthetic import SyntheticSource

KIND = "id int, v int, at timestamp"


def day(n, hour=0):
    return datetime(2026, 1, n, hour)


@pytest.fixture
def table(spark, tmp_path):
    return tables.KeyedTable(spark, str(tmp_path / "t"), "id", F.date_format("at", "yyyy-MM-dd"))


def content(table):
    return sorted(tuple(r)[:2] for r in table.read().collect())


def test_merge_updates_inserts_and_keeps(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(1)), (2, 1, day(2)), (3, 1, day(3))], KIND), "at")
    assert table.watermark("at") == day(3)
    table.merge(
        spark.createDataFrame([(1, 2, day(4)), (4, 1, day(4)), (4, 9, day(5))], KIND), "at"
    )
    assert content(table) == [(1, 2), (2, 1), (3, 1), (4, 9)]
    # The day that lost its only row is gone, the untouched days keep their first files.
    parts = table._manifest()["parts"]
    assert parts == {"2026-01-02": 1, "2026-01-03": 1, "2026-01-04": 2, "2026-01-05": 2}


def test_merge_is_repeatable(spark, table):
    batch = spark.createDataFrame([(1, 1, day(1)), (2, 1, day(2))], KIND)
    table.merge(batch, "at")
    table.merge(batch, "at")
    assert content(table) == [(1, 1), (2, 1)]


def test_an_older_row_never_replaces_a_newer_one(spark, table):
    """Whatever the order of the batches, the newest row of a key is what stays."""
    first, second = [(1, 1, day(5)), (2, 1, day(2))], [(1, 2, day(6)), (2, 0, day(1)), (3, 1, None)]
    for batches in ((first, second), (second, first)):
        for batch in batches:
            table.merge(spark.createDataFrame(batch, KIND), "at")
        assert content(table) == [(1, 2), (2, 1), (3, 1)]
        table.overwrite(spark.createDataFrame([], KIND))


def test_null_times_do_not_hide_the_watermark(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(3)), (2, 1, None)], KIND), "at")
    assert table.watermark("at") == day(3)
    late = spark.createDataFrame([(3, 1, day(2)), (4, 1, day(4))], KIND)
    table.merge(tables.later_than(late, "at", table.watermark("at")), "at")
    assert content(table) == [(1, 1), (2, 1), (4, 1)]


def test_merge_reads_the_key_range_of_the_batch(spark, table, plan):
    table.merge(spark.createDataFrame([(k, 1, day(1)) for k in range(50)], KIND), "at")
    near = table._read_with_part().filter(F.col("id").between(3, 5))
    assert "GreaterThanOrEqual(id,3)" in plan(near) and "LessThanOrEqual(id,5)" in plan(near)


def test_held_commits_are_seen_after_publication(spark, tmp_path):
    path, part = str(tmp_path / "t"), F.date_format("at", "yyyy-MM-dd")
    held = tables.KeyedTable(spark, path, "id", part, held=True)
    held.merge(spark.createDataFrame([(1, 1, day(1))], KIND), "at")
    held.merge(spark.createDataFrame([(2, 1, day(1))], KIND), "at")
    other = tables.KeyedTable(spark, path, "id", part)
    assert content(held) == [(1, 1), (2, 1)] and not other.exists()
    held.publish()
    assert content(other) == [(1, 1), (2, 1)]


def test_rows_up_to_the_watermark_never_arrive(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(5))], KIND), "at")
    late = spark.createDataFrame([(2, 1, day(4)), (1, 7, day(5)), (3, 1, day(6))], KIND)
    table.merge(tables.later_than(late, "at", table.watermark("at")), "at")
    assert content(table) == [(1, 1), (3, 1)]


def test_full_refresh_replaces_everything(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(1)), (2, 1, day(2))], KIND), "at")
    table.overwrite(spark.createDataFrame([(3, 3, day(3))], KIND))
    assert content(table) == [(3, 3)]
    assert table.partitions() == ["2026-01-03"]


def test_other_columns_are_refused(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(1))], KIND), "at")
    with pytest.raises(tables.SchemaDrift):
        table.merge(spark.createDataFrame([(1, "x", day(1))], "id int, v string, at timestamp"), "at")
    assert content(table) == [(1, 1)]


def test_a_failed_write_leaves_the_current_version(spark, table):
    table.merge(spark.createDataFrame([(1, 1, day(1))], KIND), "at")
    with pytest.raises(Exception):
        bad = spark.createDataFrame([(2, 0, day(2))], KIND)
        table.merge(bad.withColumn("v", F.raise_error(F.lit("broken")).cast("int")), "at")
    assert content(table) == [(1, 1)]
    table.merge(spark.createDataFrame([(2, 2, day(2))], KIND), "at")
    assert content(table) == [(1, 1), (2, 2)]


def test_column_named_like_a_folder_key(spark, tmp_path):
    table = tables.KeyedTable(spark, str(tmp_path / "t"), "id", F.col("version").cast("string"))
    table.merge(spark.createDataFrame([(1, 5)], "id int, version int"), "version")
    assert content(table) == [(1, 5)]


def test_snapshot_versions(spark, tmp_path):
    history = Snapshot(spark, str(tmp_path / "h"), "k", ["a", "b"])

    def extract(*rows):
        return spark.createDataFrame(list(rows), "k string, a int, b int")

    history.apply(extract(("same", 1, None), ("change", 1, 1), ("gone", 1, 1)), day(1))
    history.apply(extract(("same", 1, None), ("change", None, 1), ("new", 1, 1)), day(2))
    history.apply(extract(("same", 1, None), ("change", None, 1), ("new", 1, 1), ("gone", 1, 1)), day(2, 6))
    found = sorted(
        (r["k"], r["a"], r["valid_from"], r["valid_to"]) for r in history.read().collect()
        if r["a"] is not None
    )
    assert found == [
        ("change", 1, day(1), day(2)),
        ("gone", 1, day(1), day(2)),
        ("gone", 1, day(2, 6), None),
        ("new", 1, day(2), None),
        ("same", 1, day(1), None),
    ]
    opened = [r for r in history.read().collect() if r["valid_to"] is None]
    assert len(opened) == 4 and len({r["scd_id"] for r in history.read().collect()}) == 6


def test_raw_zone_replaces_only_its_day(spark, tmp_path):
    root = str(tmp_path)
    first = spark.range(3)
    folder = tables.write_raw_zone(first, root, "orders", "2026-01-01")
    tables.write_raw_zone(spark.range(5), root, "orders", "2026-01-02")
    tables.write_raw_zone(spark.range(7), root, "orders", "2026-01-02")
    counts = spark.read.parquet(folder).groupBy("ingestion_date").count().collect()
    assert sorted(r["count"] for r in counts) == [3, 7]
    audit = tables.landed_files(spark, {"orders": folder}).first()
    assert audit["rows"] == 10 and audit["bytes"] > 0
    today = tables.landed_files(spark, {"orders": folder}, "2026-01-02").first()
    assert today["rows"] == 7 and 0 < today["bytes"] < audit["bytes"]


def test_csv_export_quotes_every_value(spark, tmp_path):
    df = spark.createDataFrame([('a"b', None, 3)], "name string, note string, n int")
    out = tmp_path / "out"
    tables.write_csv(df, str(out), {"n": "n", "name": "label", "note": "note"})
    assert [r[0] for r in spark.read.text(str(out)).collect()] == ['"3";"a""b";""']
    assert (out / tables.HEADER_FILE).read_bytes() == b"\xef\xbb\xbfn;label;note\n"


def test_json_reports(spark, tmp_path):
    path = str(tmp_path / "r" / "x.json")
    assert files.read_json(spark, path) == {}
    files.write_json(spark, path, {"état": 1})
    assert files.read_json(spark, path) == {"état": 1}
    files.write_text(spark, path, "{broken")
    assert files.read_json(spark, path) == {}


def test_landing_names_every_missing_source(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id\n")
    with pytest.raises(MissingSources) as missing:
        LandingSource(spark, str(tmp_path)).register_views()
    assert "stock.csv" in str(missing.value) and "orders.csv" not in str(missing.value)


def test_landing_types_and_quarantine(spark, tmp_path):
    (tmp_path / "payments.csv").write_text(
        "transaction_id,order_id,amount,currency,status,payment_method,paid_at\n"
        "T1,O1,10.50,EUR,settled,card,2026-09-01T10:00:00+02:00\n"
        "T2,O2,abc,EUR,settled,card,2026-09-01T10:00:00+00:00\n"
    )
    source = LandingSource(spark, str(tmp_path), loaded_at=day(1))
    good, bad = sorted(source.table("payments").collect())
    assert str(good["amount"]) == "10.50" and good["paid_at"] == datetime(2026, 9, 1, 8)
    assert bad["amount"] is None
    assert source.quarantine("payments").count() == 1
    assert source.loaded("payments").first()["_ingested_at"] == day(1)


def test_synthetic_source_is_deterministic_and_survives_csv(spark, tmp_path):
    source = SyntheticSource(spark, datetime(2026, 9, 8, 19))
    source.write_csv(str(tmp_path))
    landing = LandingSource(spark, str(tmp_path))
    names = landing.register_views("src_")
    assert len(names) == 8
    for name in SOURCE_NAMES:
        # CSV has no empty text beside null; staging treats both alike.
        made = source.table(name)
        made = made.replace("", None, [f.name for f in made.schema if f.dataType.typeName() == "string"])
        assert sorted(landing.table(name).collect(), key=str) == sorted(made.collect(), key=str)
    again = SyntheticSource(spark, datetime(2026, 9, 8, 19)).table("orders").repartition(7)
    assert sorted(again.collect()) == sorted(source.table("orders").collect())
    other = SyntheticSource(spark, datetime(2026, 9, 8, 19), seed=7).table("orders")
    assert sorted(other.collect()) != sorted(source.table("orders").collect())
    shares = {
        r["channel"]: r["count"]
        for r in SyntheticSource(spark, datetime(2026, 9, 8), orders=20000)
        .table("orders").groupBy("channel").count().collect()
    }
    assert abs(shares["web"] / 20000 - 0.48) < 0.02 and abs(shares["store"] / 20000 - 0.44) < 0.02


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        "product_id,name,category,department,collection,price,currency\n"
        '1,"Robe ""longue""\nbleue, deux pièces",robes,F,E26,10.50,EUR\n2,Veste,vestes,H,E26,20.00,EUR\n'
    )
    source = LandingSource(spark, str(tmp_path))
    found = {r.product_id: r.name for r in source.table("products").collect()}
    assert found == {"1": 'Robe "longue"\nbleue, deux pièces', "2": "Veste"}
    assert source.quarantine("products").count() == 0


def test_a_file_too_large_for_a_task_is_refused(spark, tmp_path):
    from omnimart.sources.landing import OversizedFile

    (tmp_path / "orders.csv").write_text("order_id\n" + "x\n" * 100)
    with pytest.raises(OversizedFile, match="orders.csv"):
        LandingSource(spark, str(tmp_path), largest=50).table("orders")


def test_exports_are_whole_files(spark, tmp_path):
    df = spark.createDataFrame([(k, f'n"{k}', None) for k in range(25)], "id int, name string, note string").repartition(5)
    out = tmp_path / "out"
    tables.write_export(df, str(out), {"id": "Id", "name": "label", "note": "note"}, [F.desc("id")], rows_per_file=10)
    lines = []
    for k in range(3):
        (part,) = (out / f"file={k}").glob("part-*")
        text = part.read_bytes()
        assert text.startswith(b"\xef\xbb\xbfId;label;note\n")
        lines.append(text.decode("utf-8-sig").splitlines()[1:])
    assert [len(x) for x in lines] == [10, 10, 5]
    assert sum(lines, []) == [f'"{k}";"n""{k}";""' for k in range(24, -1, -1)]
    tables.write_export(df.limit(0), str(out), {"id": "Id"}, [F.col("id")])
    assert [r[0] for r in spark.read.text(str(out)).select("value").collect()] == ["Id"]


def test_superseded_folders_are_deleted(spark, table):
    for n in range(1, 6):
        table.merge(spark.createDataFrame([(1, n, day(1)), (n, n, day(2))], KIND), "at")
    before = content(table)
    table.tidy(keep=2)
    assert content(table) == before and len(table._versions()) == 2
    named = {v for name in table._versions() for v in tables.json.loads(files.read_text(spark, f"{table.path}/manifest/{name}"))["parts"].values()}
    assert {int(n.split("=")[1]) for n in files.children(spark, f"{table.path}/data")} == named
    table.merge(spark.createDataFrame([(1, 99, day(9))], KIND), "at")
    assert (1, 99) in content(table)


def test_pins_are_released(spark):
    from omnimart.session import pin, released

    with pytest.raises(KeyError):
        with released(spark):
            path = pin(spark.range(3), "gone").inputFiles()[0].rsplit("/", 1)[0]
            assert files.exists(spark, path)
            raise KeyError
    assert not files.exists(spark, path)
    kept = pin(spark.range(3), "kept")
    assert kept.count() == 3
