"""Streams with state of their own, against recomputations of all that came in."""

import math
import random

import pytest
from pyspark.sql import functions as F

from isobar.streaming import feeds as K
from isobar.streaming.slots import FlashFeed, SlotTable, best_rows, recomputing, upserting


def driven(spark, path, parts, schema, make, run=None, mode="append", after=None):
    """One run of the stream for each part, from the last checkpoint."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = make(spark.readStream.schema(schema).parquet(f"{path}/in"))
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/c").trigger(availableNow=True)
        writer = writer.foreachBatch(run) if run else writer.format("parquet").option("path", f"{path}/out")
        writer.start().awaitTermination()
        if after:
            after(i)


def feed_by_force(flashes, now, most=60_000):
    best = {}
    for f in flashes:
        i, lat, lon, e = f
        if now - 3600 <= e < now:
            recent = e >= now - 1800
            size, seconds = (0.01, 30) if recent else (0.08, 120)
            key = (recent, round(lat / size), round(lon / size), e // seconds)
            if key not in best or (e, -i) > (best[key][3], -best[key][0]):
                best[key] = f
    return sorted(best.values(), key=lambda f: (f[3], -f[0]))[-most:]


def test_each_pass_of_the_flash_feed_equals_a_recomputation(spark, tmp_path):
    """Late flashes within the window count, older ones don't, and flashes change tiers as time passes."""
    rng = random.Random(5)
    place = lambda: (round(30 + rng.randrange(30) * 0.004, 3), round(-100 + rng.randrange(30) * 0.004, 3))
    ends = [600, 2400, 4200, 4260, 9000]
    ids = iter(range(10**6))
    parts = []
    for end in ends:
        parts.append([(next(ids), *place(), 1_704_067_200 + rng.randrange(max(0, end - 1500), end)) for _ in range(150)])
    parts[2] += [(next(ids), *place(), 1_704_067_200 + 700 + k) for k in range(40)]  # late, within the hour
    parts[4] += [(next(ids), *place(), 1_704_067_200 + 100 + k) for k in range(40)]  # beyond it
    feed, came = FlashFeed(spark, str(tmp_path / "feed")), []

    def same(i):
        came.extend(parts[i])
        now = max(e for *_, e in came) // 30 * 30 + 30
        got = [tuple(r) for r in feed.published().select("event_id", "lat", "lon", "epoch").orderBy("epoch", F.col("event_id").desc()).collect()]
        assert got == feed_by_force(came, now) and got
        assert feed.published().select("now").distinct().collect() == [(now,)]
        assert feed.table.read().agg(F.min("epoch")).first()[0] >= now - 3600 - FlashFeed.BIN  # what has left the window is gone

    driven(spark, str(tmp_path), parts, "event_id long, lat double, lon double, epoch long", feed.changes, feed.run, "update", same)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "key long, slot long, src long, v string", "slot")
    put = upserting(table, ["key"], ["src"])
    frame = lambda rows: spark.createDataFrame(rows, "key long, slot long, src long, v string")
    read = lambda: sorted(tuple(r) for r in table.read().collect())
    put(frame([(1, 10, 5, "a"), (2, 10, 5, "b"), (3, 20, 5, "c")]), 0)
    second = [(1, 10, 4, "old"), (2, 10, 6, "new"), (9, 30, 1, "d")]
    put(frame(second), 1)
    want = [(1, 10, 5, "a"), (2, 10, 6, "new"), (3, 20, 5, "c"), (9, 30, 1, "d")]
    assert read() == want
    put(frame(second), 1)
    assert read() == want and table.batches() == [0, 1]
    put(frame([(3, 20, 7, "e")]), 2)
    put(frame([(3, 20, 6, "f")]), 3)
    assert read() == [*want[:2], (3, 20, 7, "e"), want[3]] and table.batches() == [2, 3]


def test_only_touched_slots_are_rewritten_and_old_versions_go(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "key long, slot long, src long", "slot")
    put = upserting(table, ["key"], ["src"])
    put(spark.range(50).select(F.col("id").alias("key"), (F.col("id") % 10).alias("slot"), F.lit(1).cast("long").alias("src")), 0)
    for batch in range(1, 6):
        put(spark.createDataFrame([(3, 3, batch + 1)], "key long, slot long, src long"), batch)
    versions = {p.name: sorted(v.name for v in p.iterdir() if v.is_dir()) for p in (tmp_path / "t" / "data").iterdir() if p.is_dir()}
    assert versions == {f"of_slot={s}": ["of_batch=4", "of_batch=5"] if s == 3 else ["of_batch=0"] for s in range(10)}
    assert table.read().count() == 50 and table.read(at_least=8).count() == 10
    table.replace(spark.createDataFrame([(1, 12, 9)], "key long, slot long, src long"), 6, drop_before=9)
    assert sorted(r["slot"] for r in table.read().collect()) == [9] * 5 + [12]


def test_an_index_without_its_end_does_not_count(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "key long, slot long", "slot")
    table.replace(spark.createDataFrame([(1, 1)], "key long, slot long"), 0)
    table.replace(spark.createDataFrame([(2, 1)], "key long, slot long"), 1)
    (tmp_path / "t" / "index" / "batch=1" / "_SUCCESS").unlink()
    assert [r["key"] for r in table.read().collect()] == [1]


def test_rows_within_the_overlap_are_recomputed_and_older_ones_drop(spark, tmp_path):
    schema = "key long, slot long, v long"
    raw, out = (SlotTable(spark, str(tmp_path / n), schema, "slot") for n in ("raw", "out"))
    top = lambda rows: rows.groupBy("key", "slot").agg(F.max("v").alias("v"))
    run = recomputing(raw, out, 2, top)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    run(frame([(1, 1, 5), (1, 2, 5)]), 0)
    run(frame([(1, 3, 1), (1, 2, 9), (2, 1, 4)]), 1)
    run(frame([(1, 6, 1), (1, 3, 99), (1, 4, 7), (1, 6, 0)]), 2)
    want = [(1, 1, 5), (1, 2, 9), (1, 3, 1), (1, 4, 7), (1, 6, 1), (2, 1, 4)]
    read = lambda: sorted((r["key"], r["slot"], r["v"]) for r in out.read().collect())
    assert read() == want  # 3 is more than two before 6, so the 99 is dropped
    run(frame([(1, 6, 1), (1, 3, 99), (1, 4, 7), (1, 6, 0)]), 2)
    run(frame([]), 3)
    assert read() == want


def test_best_rows_with_ties(spark):
    rows = [(1, 2, "a"), (1, 2, "b"), (1, 1, "z"), (2, 0, None)]
    assert sorted(map(str, (tuple(r) for r in best_rows(spark.createDataFrame(rows, "k int, o int, v string"), ["k"], ["o"]).collect()))) == ["(1, 2, 'b')", "(2, 0, None)"]


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def test_carried_hours_equal_a_loop(spark, tmp_path, rocks):
    rng = random.Random(8)
    hour = lambda h: f"2024-01-{1 + h // 24:02} {h % 24:02}"
    readings = {(s, h): rng.randrange(200) for s in (1, 2, 3) for h in rng.sample(range(40), 9)}
    readings[4, 39] = 7
    rows = sorted(((s, "p", f"{hour(h)}:{m:02}:00", v - m % 3) for (s, h), v in readings.items() for m in (5, 30, 48)), key=lambda r: r[2])
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :], [(None, None, "2024-01-05 00:00:00", None)]]
    parts[1], parts[2] = parts[1] + parts[2][:1], parts[2][1:]  # a row that comes before its time
    typed = lambda stream: K.carried_forward(stream.withColumn("ts", F.to_timestamp("ts")))
    driven(spark, str(tmp_path), parts, "station_id long, param string, ts string, aqi int", typed)
    got = [(r["station_id"], (r["hour"].day - 1) * 24 + r["hour"].hour, r["aqi"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    want = []
    for s in {s for s, _ in readings}:
        known = {h: v for (x, h), v in readings.items() if x == s}
        for h in range(min(known), max(known) + 4):
            before = [k for k in known if h - 3 <= k <= h]
            if before:
                want.append((s, h, known[max(before)]))
    assert sorted(got) == sorted(want) and not math.isnan(sum(v for *_, v in got))
