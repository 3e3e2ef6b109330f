"""Settled streams: what is emitted, open and late together is the input."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from omnimart.streaming import events as stream_events, matching, resends, windows

START = datetime(2026, 1, 1)


@pytest.fixture
def feed(spark, tmp_path):
    """Files that arrive one per micro-batch, in the order given."""

    def make(name, kind, *batches):
        folder = str(tmp_path / name)
        for rows in batches:
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
        return stream_events.read_event_files(spark, folder, spark.createDataFrame([], kind).schema, max_files=1)

    return make


def shuffled_batches(rows, n, seed):
    draw = random.Random(seed)
    batches = [[] for _ in range(n)]
    for k, row in enumerate(rows):
        # Most rows come in the order of time, some much later or earlier.
        batches[draw.randrange(n) if draw.random() < 0.3 else min(n - 1, k * n // len(rows))].append(row)
    return [b for b in batches if b]


EVENTS = "event_id string, event_at timestamp, latency_ms int"


def minute_rows(n, seed):
    draw = random.Random(seed)
    return [(f"e{k}", START + timedelta(seconds=37 * k), draw.choice([None, 90, 120, 500, 3100])) for k in range(n)]


def plain_windows(spark, rows):
    return sorted(map(tuple, stream_events.latency_windows(spark.createDataFrame(rows, EVENTS).filter("event_at IS NOT NULL")).collect()))


def test_windows_hold_every_event(spark, feed, tmp_path):
    rows = minute_rows(400, 1)
    stream = feed("in", EVENTS, *shuffled_batches(rows, 6, 2))
    run = windows.count_latencies(stream, str(tmp_path / "run"))
    parts = windows.parts(run)
    count = {r.part: r.n for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    assert set(count) == {"emitted", "open", "late"} and sum(count.values()) == len(rows)
    found = windows.latency_of(parts).select("window_start", "window_end", "events", "latency_p95_ms")
    assert sorted(map(tuple, found.collect())) == plain_windows(spark, rows)


def test_windows_go_on_in_a_second_run(spark, feed, tmp_path):
    rows = minute_rows(200, 3)
    feed("in", EVENTS, *shuffled_batches(rows[:120], 3, 4))
    run = windows.count_latencies(feed("in", EVENTS), str(tmp_path / "run"))
    assert windows.parts(run).agg(F.sum("n")).first()[0] == 120
    run = windows.count_latencies(feed("in", EVENTS, *shuffled_batches(rows[120:], 2, 5)), str(tmp_path / "run"))
    found = windows.latency_of(windows.parts(run)).select("window_start", "window_end", "events", "latency_p95_ms")
    assert sorted(map(tuple, found.collect())) == plain_windows(spark, rows)


FACTS = "order_id string, at timestamp, quantity int"


def test_pairs_equal_the_full_outer_join(spark, feed, tmp_path):
    left = [(f"o{k}", START + timedelta(minutes=7 * k), k % 5) for k in range(300)] + [(None, START, 1), ("untimed", None, 2)]
    right = [(f"o{k}", START + timedelta(minutes=7 * k, seconds=k % 40), k % 5 + (k % 11 == 0)) for k in range(0, 330) if k % 13]
    right += [("untimed", START, 2), (None, START, 4), ("o13", START + timedelta(days=1), 3)]
    run = matching.compare_streams(feed("l", FACTS, *shuffled_batches(left, 5, 6)), feed("r", FACTS, *shuffled_batches(right, 4, 7)), str(tmp_path / "run"))
    assert run.late("batch").count() and run.late("stream").count() and run.open_side("left").count()
    a, b = spark.createDataFrame(left, FACTS), spark.createDataFrame(right, FACTS)
    expected = a.toDF("a", "ta", "qa").join(b.toDF("b", "tb", "qb"), F.expr("a = b"), "full_outer").select("a", "qa", "b", "qb")
    found = matching.settled_pairs(run).select("batch_key", "batch_quantity", "stream_key", "stream_quantity")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, expected.collect())))


def test_rows_waiting_for_a_partner_lie_on_disk(spark, feed, tmp_path):
    """The state of a comparison holds whole batches, which need not fit into the heap; other queries keep the session's state store."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    rows = [(f"o{k}", START + timedelta(minutes=k), k) for k in range(20)]
    run = matching.compare_streams(feed("l", FACTS, rows[:10], rows[10:]), feed("r", FACTS, rows[1:]), str(tmp_path / "run"))
    offsets = (tmp_path / "run" / "checkpoint" / "offsets" / "0").read_text()
    assert "RocksDBStateStoreProvider" in offsets and "HDFSBackedStateStoreProvider" not in offsets
    assert spark.conf.get(provider) == before and provider not in spark.conf.getAll
    assert [r.order_id for r in matching.mismatches(matching.settled_pairs(run)).collect()] == ["o0"]


def test_copies_are_told_at_any_distance(spark, feed, tmp_path):
    first = [(f"e{k}", START + timedelta(minutes=k), 100 + k) for k in range(300)]
    again = [first[5], first[5], first[250], first[299]]  # long after the state has forgotten the first two
    late = [("late", START, 1), ("late", START, 1)]  # a first copy behind the watermark
    nameless = [(None, START, 1), (None, START, 1), ("untimed", None, 1), ("untimed", None, 1)]
    batches = [first[:100], first[100:200], first[200:] + nameless, again, late + nameless[2:], again + late]
    stream = feed("in", EVENTS, *batches)
    run = resends.deduplicate_ever(stream, str(tmp_path / "run"), buckets=7)
    found = sorted(map(str, map(tuple, resends.events_once(run).collect())))
    assert found == sorted(map(str, map(tuple, {*first, *late, ("untimed", None, 1)})))
    assert run.late(resends.NAMELESS).count() == 2
    # An id leaves the state an hour after its event, by a watermark that is an hour behind the newest: 120 of 300 are left.
    state = spark.read.format("statestore").option("operatorId", 0).load(run.checkpoint)
    assert 0 < state.count() <= 121


def test_deduplication_of_an_empty_stream(feed, tmp_path):
    run = resends.deduplicate_ever(feed("in", EVENTS, []), str(tmp_path / "run"))
    assert resends.events_once(run).collect() == []
