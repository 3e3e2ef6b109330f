from collections import Counter

import pytest
from pyspark.sql import functions as F

from omnimart.llm import shard_table

NAMES = [f"s{k}" for k in range(7)]


def plain_fill(shards, slots):
    """Turn by turn over written-out preference lists."""
    prefer = {s: [(shard_table._digest(s, "offset") + j * (shard_table._digest(s, "step") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards}
    owner = {}
    while len(owner) < slots:
        for s in sorted(shards):
            free = next((p for p in prefer[s] if p not in owner), None)
            if free is not None:
                owner[free] = s
    return [owner[k] for k in range(slots)]


@pytest.mark.parametrize("slots", [7, 101, 503])
def test_table_equals_preference_lists(slots):
    assert [NAMES[i] for i in shard_table.fill(NAMES, slots)] == plain_fill(NAMES, slots)


def test_equal_shares_and_few_moves():
    before = shard_table.fill(NAMES, 5003)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    after = shard_table.fill(NAMES[:-1], 5003)
    kept = [(a, b) for a, b in zip(before, after) if a != 6]
    assert sum(a != b for a, b in kept) < 0.1 * len(kept)
    assert [NAMES[::-1][i] for i in shard_table.fill(NAMES[::-1], 5003)] == [NAMES[i] for i in before]


def test_rows_get_the_slot_of_their_hash(spark):
    rows = spark.createDataFrame([(k % 50, str(k)) for k in range(200)] + [(None, "n"), (None, "m")], "key long, other string")
    table = shard_table.fill(NAMES, 101)
    found = shard_table.place(rows, "key", NAMES, 101).withColumn("own", F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(101))).collect()
    assert len(found) == 202 and all(r.slot == r.own and r.shard == NAMES[table[r.slot]] for r in found)
    assert len({r.shard for r in found if r.key is None}) == 1


def test_one_lookup_without_shuffle_or_python(spark, plan):
    text = plan(shard_table.place(spark.range(1000).withColumnRenamed("id", "key"), "key", NAMES, 101))
    assert "BroadcastHashJoin" in text and "Python" not in text and "Exchange hashpartitioning" not in text


def test_empty_long_and_clashing(spark):
    rows = spark.createDataFrame([("k" * 1_000_000, 1), ("", 2)], "`a key` string, n int")
    assert shard_table.place(rows, "a key", NAMES, 101).count() == 2
    assert shard_table.place(rows.limit(0), "a key", NAMES, 101).count() == 0
    with pytest.raises(ValueError):
        shard_table.place(rows.withColumnRenamed("n", "slot"), "a key", NAMES)
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), ([str(k) for k in range(8)], 7)):
        with pytest.raises(ValueError):
            shard_table.fill(shards, slots)
