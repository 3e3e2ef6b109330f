import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from omnimart.operators.tables import KeyedTable
from omnimart.streaming import events, sinks, validation

EVENT = {
    "event_id": "e1",
    "event_type": "purchase",
    "source_customer_id": "WEB-1",
    "product_id": "P1",
    "event_at": "2026-09-02T08:00:00Z",
    "quantity": 2,
}
KIND = "event_id string, event_at timestamp, latency_ms int, source_customer_id string"


def encoded(payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return base64.b64encode(text.encode()).decode()


def without(field):
    return {k: v for k, v in EVENT.items() if k != field}


def results(spark, *records):
    df = spark.createDataFrame(list(records), "recordId string, data string")
    return {r["recordId"]: r for r in validation.validate_records(df).collect()}


def test_good_record_is_enriched(spark):
    found = results(spark, ("1", encoded(EVENT)))["1"]
    text = base64.b64decode(found["data"]).decode()
    assert found["result"] == "Ok" and text.endswith("\n")
    assert json.loads(text) == {
        **EVENT,
        "schema_version": "retail-event/2.1",
        "idempotency_key": "e1",
    }


def test_good_records_become_typed_rows(spark):
    df = spark.createDataFrame(
        [("1", encoded(EVENT)), ("2", encoded(without("event_id")))], "recordId string, data string"
    )
    kind = "event_id string, quantity int, schema_version string"
    found = validation.decode_good(validation.validate_records(df), kind).collect()
    assert [tuple(r) for r in found] == [("e1", 2, "retail-event/2.1")]


def test_long_records_stay_on_one_line(spark):
    found = results(spark, ("1", encoded({**EVENT, "note": "x" * 500})))["1"]
    assert "\n" not in found["data"] and json.loads(base64.b64decode(found["data"]))["note"] == "x" * 500


@pytest.mark.parametrize("field", validation.REQUIRED_FIELDS)
def test_missing_field_fails_and_keeps_the_data(spark, field):
    data = encoded(without(field))
    found = results(spark, ("1", data))["1"]
    assert (found["result"], found["data"]) == ("ProcessingFailed", data)


def test_bad_records_fail_alone(spark):
    found = results(
        spark,
        ("list", encoded("[1]")),
        ("text", encoded("nope")),
        ("base64", "###"),
        ("nothing", None),
        ("bytes", base64.b64encode(b"\xff\xfe").decode()),
        ("no time", encoded({**EVENT, "event_at": None})),
        ("bad time", encoded({**EVENT, "event_at": "soon"})),
        (None, encoded(EVENT)),
        ("null id", encoded({**EVENT, "event_id": None})),
        ("repeated", encoded('{"event_id": "old", ' + json.dumps(EVENT)[1:])),
        ("versioned", encoded({**EVENT, "schema_version": "0"})),
    )
    good = {k for k, r in found.items() if r["result"] == "Ok"}
    assert good == {"null id", "repeated", "versioned"}
    assert "unknown" in found and found["nothing"]["data"] == ""
    assert json.loads(base64.b64decode(found["repeated"]["data"]))["event_id"] == "e1"
    assert json.loads(base64.b64decode(found["versioned"]["data"]))["schema_version"] == "retail-event/2.1"


def test_envelope_is_unpacked(spark):
    kind = "records array<struct<recordId: string, data: string>>"
    df = spark.createDataFrame([([("1", "a"), ("2", "b")],)], kind)
    assert sorted(map(tuple, validation.unpack_envelope(df).collect())) == [("1", "a"), ("2", "b")]


def at(minute, second=0):
    return datetime(2026, 1, 1, 0, minute, second)


@pytest.fixture
def feed(spark, tmp_path):
    """A stream whose files arrive one per micro-batch."""

    class Feed:
        folder = str(tmp_path / "in")
        checkpoint = str(tmp_path / "checkpoint")
        out = str(tmp_path / "out")

        def add(self, *rows):
            spark.createDataFrame(list(rows), KIND).coalesce(1).write.mode("append").parquet(self.folder)

        def stream(self, max_files=1):
            schema = spark.createDataFrame([], KIND).schema
            return events.read_event_files(spark, self.folder, schema, max_files=max_files)

        def read(self):
            return spark.read.parquet(self.out)

    return Feed()


def test_copies_in_later_batches_are_dropped(feed):
    feed.add(("a", at(1), 1, "c"), ("a", at(1), 1, "c"), ("b", at(2), 1, "c"))
    feed.add(("a", at(1), 1, "c"), ("c", at(3), 1, "c"))
    sinks.append_parquet(events.deduplicate(feed.stream(), "10 minutes"), feed.out, feed.checkpoint)
    assert sorted(r["event_id"] for r in feed.read().collect()) == ["a", "b", "c"]
    # A restart resumes from its checkpoint and still knows the ids.
    feed.add(("c", at(3), 1, "c"), ("d", at(4), 1, "c"))
    sinks.append_parquet(events.deduplicate(feed.stream(), "10 minutes"), feed.out, feed.checkpoint)
    assert sorted(r["event_id"] for r in feed.read().collect()) == ["a", "b", "c", "d"]


def test_windows_close_behind_the_watermark(feed, spark):
    feed.add(*[(f"e{i}", at(1, i), 100 * i, "c") for i in range(1, 41)])
    feed.add(("x", at(30), 1, "c"))
    windows = events.latency_windows(feed.stream(), "5 minutes")
    sinks.append_parquet(events.alarms(windows), feed.out, feed.checkpoint)
    found = feed.read().collect()
    assert [(r["events"], r["latency_p95_ms"]) for r in found] == [(40, 3800)]


def test_open_windows_of_a_finite_source_come_from_its_stored_events(feed, spark):
    """The stream keeps the last minutes in state; with the stored events no window is missing."""
    feed.add(*[(f"e{i}", at(1 + i // 2, i), 100 * i, "c") for i in range(1, 41)], ("n", at(3), None, "c"))
    stored = spark.read.parquet(feed.folder)
    windows = events.latency_windows(feed.stream(), "5 minutes")
    sinks.append_parquet(windows, feed.out, feed.checkpoint)
    every = events.with_open_windows(spark.read.schema(windows.schema).parquet(feed.out), stored)
    assert feed.read().count() < every.count()
    assert sorted(every.collect()) == sorted(events.latency_windows(stored).collect())
    nothing = spark.createDataFrame([], windows.schema)
    assert sorted(events.with_open_windows(nothing, stored).collect()) == sorted(every.collect())


def test_threshold_is_late_on_screen_but_no_alarm(spark):
    rows = [("a", at(1), 3000, "c"), ("b", at(2), 3001, "c")]
    windows = events.latency_windows(spark.createDataFrame(rows, KIND))
    assert sorted(r["latency_p95_ms"] for r in events.alarms(windows).collect()) == [3001]
    assert [r["late"] for r in events.is_late(windows).collect()] == [True, True]


def test_enrichment_leaves_out_and_reports_unresolved(feed, spark):
    feed.add(("a", at(1), 1, "WEB-1"), ("b", at(1), 1, "WEB-2"))
    bridge = spark.createDataFrame([("WEB-1", "C1")], "source_customer_id string, customer_id string")
    sinks.append_parquet(events.enrich(feed.stream(), bridge), feed.out, feed.checkpoint)
    assert [(r["event_id"], r["customer_id"]) for r in feed.read().collect()] == [("a", "C1")]
    lost = events.unresolved_events(spark.read.parquet(feed.folder), bridge)
    assert [r["event_id"] for r in lost.collect()] == ["b"]


def fact(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "fact"), "event_id", F.date_format("event_at", "yyyy-MM-dd"))


def test_merge_sink_keeps_late_rows_unless_strict(feed, spark, tmp_path):
    feed.add(("a", at(5), 1, "c"), ("a", at(6), 2, "c"))
    feed.add(("late", at(1), 1, "c"), ("b", at(9), 1, "c"))
    table = fact(spark, tmp_path)
    sinks.run_available(feed.stream(), feed.checkpoint, sinks.merge_into(table, "event_at"))
    assert sorted((r["event_id"], r["latency_ms"]) for r in table.read().collect()) == [
        ("a", 2),
        ("b", 1),
        ("late", 1),
    ]
    strict = KeyedTable(spark, str(tmp_path / "strict"), "event_id", F.date_format("event_at", "yyyy-MM-dd"))
    handle = sinks.merge_into(strict, "event_at", strict=True)
    files = [spark.createDataFrame([("a", at(5), 1, "c")], KIND), spark.createDataFrame([("late", at(1), 1, "c"), ("b", at(9), 1, "c")], KIND)]
    for i, batch in enumerate(files):
        handle(batch, i)
    assert sorted(r["event_id"] for r in strict.read().collect()) == ["a", "b"]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = fact(spark, tmp_path)
    batch = spark.createDataFrame([("a", at(5), 1, "c"), ("b", at(6), 2, "c")], KIND)
    handle = sinks.merge_into(table, "event_at")
    handle(batch, 0)
    handle(batch, 0)
    assert table.read().count() == 2


def test_routing_is_repeatable(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    df = spark.createDataFrame([("1", "Ok", "x"), ("2", "ProcessingFailed", "y")], "recordId string, result string, data string")
    handle = sinks.route_validated(good, bad)
    handle(df, 0)
    handle(df, 0)
    assert [r["recordId"] for r in spark.read.parquet(good).collect()] == ["1"]
    assert [r["recordId"] for r in spark.read.parquet(bad).collect()] == ["2"]


def test_json_lines_hold_at_most_500_records(spark, tmp_path):
    rows = [(f"e{i}", "2026-01-01T00:00:00", "hot" if i % 3 else f"k{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id string, event_at string, partition_key string").select(
        "*",
        F.lit("view").alias("event_type"),
        F.lit("WEB-1").alias("source_customer_id"),
        F.lit(None).cast("string").alias("product_id"),
    )
    lines = sinks.json_lines(df)
    assert lines.filter("not valid").count() == 0
    sinks.write_json_lines(lines, str(tmp_path / "lines"))
    stored = spark.read.text(str(tmp_path / "lines")).select("value", F.input_file_name().alias("f"))
    assert stored.count() == 2000
    assert max(r["count"] for r in stored.groupBy("f").count().collect()) <= 500
    first = json.loads(stored.first()["value"])
    assert first["product_id"] is None and first["idempotency_key"] == first["event_id"]


def test_sample_is_bounded(spark):
    assert events.sample(spark.range(100)).count() == 10


def test_null_keys_of_a_stream_batch_are_refused(spark, feed, tmp_path):
    """A row without a key could not be found again; its batch fails and the table stays as it was."""
    feed.add(("a", at(1), 1, "WEB-1"))
    table = KeyedTable(spark, str(tmp_path / "keyed"), "event_id", F.date_format("event_at", "yyyy-MM-dd"))
    sinks.run_available(feed.stream(), feed.checkpoint, sinks.merge_into(table, "event_at"))
    feed.add((None, at(2), 1, "WEB-1"))
    with pytest.raises(Exception, match="a key is null"):
        sinks.run_available(feed.stream(), feed.checkpoint, sinks.merge_into(table, "event_at"))
    assert [r.event_id for r in table.read().collect()] == ["a"]


def test_lines_of_plain_events_are_those_of_their_parsed_fields(spark, monkeypatch):
    """An event of texts, integers and times is not parsed from its own text, others once for all conditions."""
    kind = "event_id string, event_type string, source_customer_id string, product_id string, event_at timestamp, n int, b boolean, partition_key string"
    texts = ["a", "}", "]", "[x]", '"', "\\", "\n\t\r\x00\x1f\x7f", "é 😀", "", None, "null", "1.50", "/", "</a>", "[", "}}"]
    rows = [(t, t, "c", t, at, n, b, "k") for t in texts for at, n, b in ((datetime(2026, 1, 1, 2, 3, 4, 567000), 7, True), (None, None, None), (datetime(1, 1, 1), -1, False))]
    df = spark.createDataFrame(rows, kind).unionByName(spark.createDataFrame(rows[:1], kind).withColumn("event_at", F.expr("timestamp_seconds(-70000000000)"))).unionByName(spark.createDataFrame(rows[:1], kind).withColumn("event_at", F.expr("timestamp_seconds(300000000000)")))
    frames = [df, df.withColumn("event_at", F.col("event_at").cast("string")), df.drop("event_id"), df.drop("event_at"), df.withColumn("event_at", F.lit("2026-01-01T00:00:00Z")), df.withColumn("event_id", F.col("n").cast("bigint"))]
    for frame in frames:
        found = sinks.json_lines(frame)
        assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(sinks, "is_plain", lambda schema: False)
            parsed = sinks.json_lines(frame)
        assert parsed.filter("valid")._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
        assert found.schema.names == parsed.schema.names and sorted(map(str, found.collect())) == sorted(map(str, parsed.collect()))
    assert "from_json" in sinks.json_lines(df.withColumn("x", F.lit(1.5)))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in sinks.json_lines(df.withColumn("schema_version", F.lit("old")))._jdf.queryExecution().optimizedPlan().toString()
