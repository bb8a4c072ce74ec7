import os

from pyspark.sql import functions as F

from tests.conftest import rows
from trailmark.config import work_path
from trailmark.streaming.jobs import UpdateLog, latest

SCHEMA = "user string, slice timestamp, n long"


def batch(spark, i):
    """Batch ``i`` updates the users of its own day and of the day before."""
    day = F.expr(f"timestamp'2024-01-01' + make_dt_interval({i} div 5)")
    rows_of = spark.range(8).select(F.concat(F.lit("u"), (F.col("id") + i % 3).cast("string")).alias("user"), day.alias("slice"), (F.col("id") * 100 + i).alias("n"))
    return rows_of.unionByName(rows_of.limit(2).withColumn("slice", F.col("slice") - F.expr("interval 1 day")))


def size(path):
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    return len(files), sum(map(os.path.getsize, files))


def test_log_stays_level_and_right(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    keys = ["user", "slice"]
    log, whole = UpdateLog(spark, work_path(spark, "log"), keys, schema), UpdateLog(spark, work_path(spark, "log"), keys, schema)
    behind, writes = [], []
    for i in range(50):
        for each in (log, whole):
            each.write(batch(spark, i).coalesce(1), i)
        if i % 5 == 4:
            before = log.folded.snapshot()
            reader = log.latest()
            wanted = rows(whole.latest(), *keys)
            assert log.fold() == (4 if i == 4 else 5)
            # A reader that began before the fold still finds all it needs, and a new one reads the fold.
            assert rows(reader, *keys) == wanted == rows(log.latest(), *keys)
            after = log.folded.snapshot()
            writes.append({p for p in after.parts("rows") if before.parts("rows").get(p) != after.parts("rows")[p]})
            behind.append(len([d for d in os.listdir(log.path) if d.startswith("batch=")]))
    assert max(behind) <= 11
    assert size(log.path)[0] < size(whole.path)[0] + 12
    # A fold writes only slices that its batches touched, so old ones stay as they are.
    assert all(len(w) <= 3 for w in writes)
    assert rows(latest(spark, log.path, keys, schema), *keys) == rows(whole.latest(), *keys)
    assert log.fold() == 0


def test_replayed_batch_counts_once(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    log = UpdateLog(spark, work_path(spark, "log"), ["user", "slice"], schema)
    for i in (0, 1, 2):
        log.write(batch(spark, i), i)
    assert log.fold() == 2
    log.write(batch(spark, 2).withColumn("n", F.lit(-1).cast("long")), 2)  # the newest may come again
    got = {r["n"] for r in log.latest().collect()}
    assert -1 in got and not any(n >= 0 and n % 100 == 2 for n in got)


def test_log_without_a_time_among_its_keys(spark):
    schema = spark.createDataFrame([], "user string, n long").schema
    log = UpdateLog(spark, work_path(spark, "log"), ["user"], schema)
    for i in range(4):
        log.write(batch(spark, i).groupBy("user").agg(F.max("n").alias("n")), i)
    want = rows(log.latest(), "user")
    assert log.fold() == 3 and rows(log.latest(), "user") == want
