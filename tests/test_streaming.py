from datetime import date

from pyspark.sql import Row
from pyspark.sql.types import StructType

from pressmill.operators.periods import PeriodStore
from pressmill.session import work_path
from pressmill.streaming import ingest as st
from pressmill.streaming import versions


def _land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_ingest_appends_only_unseen_rows(spark):
    schema = "ord long, url string, topic string"
    landing, root = work_path(spark, "landing"), work_path(spark, "period")
    store = PeriodStore(spark, root)
    lots = [[(1, "a", "x"), (2, "b", "x")], [(3, "a/", "x"), (4, "a", "y")], [(5, "b", "x"), (6, "", "x")]]
    for lot in lots:
        _land(spark, lot, schema, landing)
        stream = st.landed(spark, landing, spark.createDataFrame([], schema).schema)
        st.ingest_append(stream, store, root + "/checkpoint").awaitTermination()
    assert sorted(r.ord for r in store.read_open().collect()) == [1, 2, 4, 6]


def test_first_arrival_per_key_over_batches(spark):
    schema = "k string, ts timestamp, n int"
    landing, out = work_path(spark, "landing"), work_path(spark, "out")
    day = lambda rows: [(k, F_TS(d), n) for k, d, n in rows]
    _land(spark, day([("a", 1, 1), ("a", 2, 2), ("b", 2, 3)]), schema, landing)
    fields = spark.createDataFrame([], schema).schema

    def run():
        stream = st.dedupe_stream(st.landed(spark, landing, fields), ["k"], "ts", "10 days")
        st.to_table(stream, out, out + "_checkpoint").awaitTermination()

    run()
    _land(spark, day([("a", 3, 4), ("c", 3, 5)]), schema, landing)
    run()
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 3, 5]


def F_TS(day):
    import datetime

    return datetime.datetime(2024, 1, day)


def test_late_rows_refresh_recent_and_missing_days_only(spark):
    schema = "source string, topic string, day date, k int, v int, version int"
    landing, table = work_path(spark, "landing"), work_path(spark, "days")
    fields = spark.createDataFrame([], schema).schema
    date = lambda d: F_TS(d).date()

    def run(rows):
        _land(spark, [("s", "t", date(d), k, v, n) for d, k, v, n in rows], schema, landing)
        stream = st.landed(spark, landing, fields)
        st.late_refresh(stream, table, ["source", "day", "k"], "version", table + "_checkpoint", 2).awaitTermination()

    run([(1, 1, 10, 0), (9, 1, 90, 0), (10, 1, 100, 0)])
    # Day 1 is closed, day 5 was never held, day 10 is edited and grows.
    run([(1, 1, 11, 1), (5, 1, 50, 1), (10, 1, 101, 1), (10, 2, 7, 1)])
    rows = spark.read.schema(fields).parquet(table).collect()
    assert sorted((r.day.day, r.k, r.v) for r in rows) == [(1, 1, 10), (5, 1, 50), (9, 1, 90), (10, 1, 101), (10, 2, 7)]


def test_counts_close_with_the_watermark(spark):
    schema = "ts timestamp, s string"
    landing, out = work_path(spark, "landing"), work_path(spark, "counts")
    fields = spark.createDataFrame([], schema).schema

    def run(days):
        _land(spark, [(F_TS(d), "s") for d in days], schema, landing)
        stream = st.daily_counts(st.landed(spark, landing, fields), "ts", ["s"], "2 days")
        st.to_table(stream, out, out + "_checkpoint").awaitTermination()
        return {(r.day.day, r.n) for r in spark.read.parquet(out).collect()}

    assert run([1, 1, 2]) == set()
    assert run([2, 3, 20]) == {(1, 2), (2, 2), (3, 1)}
    assert run([3, 21]) == {(1, 2), (2, 2), (3, 1)}


def test_changed_versions_open_their_own_days_only(spark):
    schema = "source string, topic string, day date, k long, v long, version int"
    landing, table = work_path(spark, "landing"), work_path(spark, "days")
    fields = spark.createDataFrame([], schema).schema

    def run(rows):
        _land(spark, [("s", "t", date(2024, 1, d), k, v, ver) for d, k, v, ver in rows], schema, landing)
        stream = st.landed(spark, landing, fields)
        versions.refresh_changed(
            stream, table, ["source", "k"], "version", table + "_checkpoint", 4
        ).awaitTermination()
        held = spark.read.schema(fields).parquet(table)
        files = {f for (f,) in held.select("_metadata.file_path").distinct().collect()}
        return sorted((r.day.day, r.k, r.v) for r in held.collect()), files

    held, files = run([(1, 1, 10, 0), (8, 3, 80, 0), (9, 2, 90, 0), (10, 4, 100, 0), (10, 4, 99, -1)])
    assert held == [(1, 1, 10), (8, 3, 80), (9, 2, 90), (10, 4, 100)]
    # Day 1 is closed, day 5 was never held, key 4 is edited, an old version comes late.
    held, later = run([(1, 1, 11, 1), (5, 5, 50, 1), (10, 4, 101, 1), (9, 2, 0, -1)])
    assert held == [(1, 1, 10), (5, 5, 50), (8, 3, 80), (9, 2, 90), (10, 4, 101)]
    assert len(files & later) == 3  # days 1, 8 and 9 are as they were
    # A row moves: its day is left empty and goes.
    held, last = run([(10, 3, 81, 2)])
    assert held == [(1, 1, 10), (5, 5, 50), (9, 2, 90), (10, 3, 81), (10, 4, 101)]
    assert len(later & last) == 3


class _Counted:
    """A state handle and its one value, which counts the calls."""

    def __init__(self):
        self.calls, self.value, self.now = 0, None, 1000

    def getValueState(self, name, schema, ttl_ms):
        return self

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_keys_of_a_bucket_share_the_calls_for_state():
    schema = StructType().add("source", "string").add("topic", "string").add("day", "date")
    schema = schema.add("k", "double").add("version", "long")
    state = _Counted()

    def run(rows):
        made = [Row(source="s", topic="t", day=date(2024, 1, d), k=k, version=v) for d, k, v in rows]
        return [(r.k, r.version, r.was_day) for r in newest.handleInputRows((0,), iter(made), state)]

    newest = versions._Newest(schema, ["source", "k"], "version", 500)
    newest.init(state)
    assert len(run([(1, float(n), 0) for n in range(100)])) == 100 and state.calls == 2
    nan = float("nan")
    assert [r[1:] for r in run([(1, nan, 0), (1, None, None), (2, nan, 1)])] == [(1, None), (None, None)]
    assert run([(3, 5.0, 1), (3, 6.0, 0), (2, nan, 1), (4, None, None)]) == [(5.0, 1, date(2024, 1, 1))]
    state.now = 1500  # all keys are older than their time to live
    assert run([(3, 6.0, 0)]) == [(6.0, 0, None)]
