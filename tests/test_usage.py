import datetime as dt

from pyspark.sql import functions as F

from tabwright.streaming import score as ST
from tabwright.streaming import usage as U

START = dt.datetime(2024, 1, 1)


def at(day, hour=12):
    return START + dt.timedelta(days=day, hours=hour)


def brute(rows, windows, until):
    days = {}
    for k, ts, big in rows:
        days.setdefault(k, []).append(((ts - START).days, big))
    out = set()
    for k, seen in days.items():
        for t in {d + x for d, _ in seen for x in (0, *windows)}:
            if t <= until:
                out.add((k, (START + dt.timedelta(days=t)).date(), sum(t - windows[0] < d <= t for d, _ in seen), sum(t - windows[1] < d <= t and b for d, b in seen)))
    return out


def test_batches_restart_and_late_rows(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    counts = {"n": (3, F.lit(True)), "big": (10, F.col("v") > 5)}

    def send(rows):
        spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int").coalesce(1).write.mode("append").parquet(src)

    def run():
        schema = spark.read.parquet(src).schema
        stream = U.running_usage(ST.table_stream(spark, src, schema=schema, files_per_batch=1), "k", "ts", counts, "1 day")
        ST.write_batches(stream, out, check).awaitTermination()
        return [tuple(r) for r in spark.read.parquet(out).select("k", "day", "n", "big").collect()]

    first = [("a", at(0), 9), ("a", at(0, 1), 1), ("b", at(1), 9), (None, at(2), 9), ("a", at(4), 7)]
    send(first)
    got = run()
    # the latest event is on day 4: days up to 2 are complete
    assert len(got) == len(set(got)) and set(got) == brute([(k, t, v > 5) for k, t, v in first], (3, 10), 2)
    # the query starts again with its state; a row in time counts, one behind the watermark does not
    second = [("b", at(5), 9), ("a", at(3, 20), 9)]
    send([*second, ("a", at(1), 9)])
    got = run()
    assert len(got) == len(set(got)) and set(got) == brute([(k, t, v > 5) for k, t, v in first + second], (3, 10), 3)
    # much later: everything ages out by timers, without rows of the keys
    last = [("z", at(60), 1)]
    send(last)
    got = run()
    assert len(got) == len(set(got)) and set(got) == brute([(k, t, v > 5) for k, t, v in first + second + last], (3, 10), 58)
    assert {(k, n, b) for k, d, n, b in got if d == max(x[1] for x in got if x[0] == k)} == {("a", 0, 0), ("b", 0, 0), (None, 0, 0)}


def test_changes():
    days = {0: [2, 1], 5: [1, 0]}
    assert U.changes(days, [3, 10], -9, 6) == [(0, [2, 1]), (3, [0, 1]), (5, [1, 1])]
    assert U.changes(days, [3, 10], 6, 100) == [(8, [0, 1]), (10, [0, 0]), (15, [0, 0])]


def test_keys_that_share_a_state(spark, tmp_path):
    import random

    rnd = random.Random(8)
    big = (1 << 60) + 1  # beyond what a double holds
    rows = [(None if i % 9 == 0 else big + i % 9, at(rnd.randrange(40), rnd.randrange(24)), rnd.randrange(9)) for i in range(400)]
    rows.sort(key=lambda r: r[1])
    schema = "k bigint, ts timestamp_ntz, v int"
    counts = {"n": (3, F.lit(True)), "big": (10, F.col("v") > 5)}
    for buckets in (1, 4):
        src, out, check = (str(tmp_path / f"{n}{buckets}") for n in ("src", "out", "check"))
        for part in (rows[:150], rows[150:300], rows[300:]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            stream = U.running_usage(ST.table_stream(spark, src, schema=spark.read.parquet(src).schema), "k", "ts", counts, "1 day", buckets)
            assert [f.dataType.simpleString() for f in stream.schema] == ["bigint", "date", "bigint", "bigint"]
            ST.write_batches(stream, out, check).awaitTermination()
        got = [tuple(r) for r in spark.read.parquet(out).select("k", "day", "n", "big").collect()]
        until = (rows[-1][1] - dt.timedelta(days=1) - START).days - 1
        assert len(got) == len(set(got)) and set(got) == brute([(k, t, v > 5) for k, t, v in rows], (3, 10), until)


def test_files_are_written_in_the_order_of_time(spark, tmp_path):
    from tabwright.plans.queries_streaming import in_order

    df = spark.range(600, numPartitions=3).select("id", (F.lit(START) + F.make_dt_interval(mins=F.col("id") * 7919 % 600)).cast("timestamp_ntz").alias("ts"))
    in_order(df, "ts", 6, str(tmp_path / "src"))
    files = sorted((tmp_path / "src").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    spans = [spark.read.parquet(str(f)).agg(F.min("ts"), F.max("ts"), F.count("id")).first() for f in files]
    assert len(files) == 6 and sum(s[2] for s in spans) == 600 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
