import random

import pytest

from pressmill.operators import dedupe as dd
from pressmill.operators.periods import PeriodStore
from pressmill.session import work_path, written

ROWS = "ord long, scope string, url string, title string"


def sequential(rows):
    """The rule as it is stated: one pass, remembering what was kept."""
    kept, seen = [], {}
    for ord_, scope, url, title in sorted(rows):
        urls, titles = seen.setdefault(scope, (set(), set()))
        bare = (title or "").strip()
        if (url and url in urls) or (bare and bare in titles):
            continue
        if url:
            urls.add(url)
        if bare:
            titles.add(bare)
        kept.append(ord_)
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_greedy_equals_sequential(spark, seed):
    rng = random.Random(seed)
    n = 300
    rows = [
        (
            i,
            rng.choice("ab"),
            rng.choice(["", None] + [f"u{k}" for k in range(40 + 60 * seed)]),
            rng.choice(["", "  "] + [f" t{k}" for k in range(40 + 30 * seed)]),
        )
        for i in rng.sample(range(10 * n), n)
    ]
    out = dd.dedupe_greedy(spark.createDataFrame(rows, ROWS), ["scope"])
    assert sorted(r.ord for r in out.collect()) == sequential(rows)


def test_greedy_long_chain_and_hot_url(spark):
    chain = [(i, "a", f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(14)]
    hot = [(100 + i, "b", "same", f"x{i % 7}") for i in range(200)]
    rows = chain + hot
    out = dd.dedupe_greedy(spark.createDataFrame(rows, ROWS), ["scope"])
    assert sorted(r.ord for r in out.collect()) == sequential(rows)


def _period(spark, rows):
    return spark.createDataFrame(rows, "ord long, url string, topic string")


def test_append_twice_adds_nothing(spark):
    old = _period(spark, [(1, "a/", "x"), (2, "b", "x"), (2, "b", "x")])
    new = _period(spark, [(3, " a", "x"), (4, "c", "x"), (5, "c//", "x"), (6, "a", "y")])
    once = dd.append_new_only(old, new)
    assert sorted(r.ord for r in once.collect()) == [1, 2, 2, 4, 6]
    assert dd.append_new_only(once, new).count() == once.count()


def test_append_keeps_urlless_rows_and_first_repeats(spark):
    old = _period(spark, [(1, "a", "x")])
    new = _period(spark, [(2, "", "x"), (3, None, "x"), (4, " / ", "x")])
    assert dd.append_new_only(old, new).count() == 4
    repeated = _period(spark, [(2, "a", "x"), (1, "a", "x"), (3, "", "x"), (4, "", "x")])
    for held in (None, old.limit(0)):
        assert sorted(r.ord for r in dd.append_new_only(held, repeated).collect()) == [1, 3, 4]


def test_period_store(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    assert store.read_open() is None and store.read_archive() is None
    store.close("nothing open")
    store.append(_period(spark, [(1, "a", "x")]))
    again = _period(spark, [(2, "a", "x"), (3, "b", "x")])
    for _ in range(2):
        assert sorted(r.ord for r in store.append(again, batch=7).collect()) == [1, 3]
    replaced = store.replace(store.read_open().filter("ord = 3"))
    assert [r.ord for r in replaced.collect()] == [3]
    store.close("p1")
    store.append(_period(spark, [(9, "a", "x")]))
    store.close("p1")
    held = store.read_archive().collect()
    assert sorted((r.period_id, r.ord) for r in held) == [("p1", 3), ("p1", 9)]
    assert store.read_open() is None


def test_greedy_treats_null_scopes_as_one(spark):
    rows = [(1, None, "a", ""), (2, None, "b", ""), (3, "x", "a", ""), (4, None, "a", "")]
    df = spark.createDataFrame(rows, "ord long, topic string, url string, title string")
    assert sorted(r.ord for r in dd.dedupe_greedy(df, ["topic"]).collect()) == [1, 2, 3]


def test_greedy_refuses_an_order_with_ties(spark):
    rows = [(1, "x", "a", ""), (2, "x", "b", ""), (2, "x", "a", "")]
    df = spark.createDataFrame(rows, "ord long, topic string, url string, title string")
    with pytest.raises(ValueError, match="tell the rows"):
        dd.dedupe_greedy(df, ["topic"])


def test_batches_of_two_writers_stay(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    store.append(_period(spark, [(1, "a", "x")]))
    store.append(_period(spark, [(2, "b", "x")]), batch=0, writer="stream")
    store.append(_period(spark, [(3, "c", "x")]), batch=0)
    again = store.append(_period(spark, [(2, "b", "x"), (4, "d", "x")]), batch=0, writer="stream")
    assert sorted(r.ord for r in again.collect()) == [1, 2, 3, 4]
    assert sorted(r.ord for r in store.compact().collect()) == [1, 2, 3, 4]


def test_a_break_before_the_mark_leaves_no_stale_rows(spark, monkeypatch):
    store = PeriodStore(spark, work_path(spark, "period"))
    store.append(_period(spark, [(1, "a", "x"), (2, "b", "x")]))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(PeriodStore, "_mark_closed", broken)
        with pytest.raises(RuntimeError):
            store.replace(store.read_open().filter("ord = 1"))
        with pytest.raises(RuntimeError):
            store.close("p0")
    assert store.read_open().count() == 2
    store.close("p1")
    assert store.read_open() is None
    assert store.append(_period(spark, [(5, "a", "x")])).count() == 1
    assert store.read_archive().count() == 2


def _chain(n, scope):
    """Each row shares its url with the one before or its title with the one behind."""
    return [(i, scope, f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(n)]


def test_a_chain_of_5000_rows_takes_few_writes(spark, monkeypatch):
    names = []

    def noted(df, name):
        names.append(name)
        return written(df, name)

    monkeypatch.setattr(dd, "written", noted)
    monkeypatch.setattr("pressmill.operators.components.written", noted)
    rows = _chain(5000, "a")
    out = dd.dedupe_greedy(spark.createDataFrame(rows, ROWS), ["scope"])
    assert sorted(r.ord for r in out.collect()) == sequential(rows)
    assert len(names) <= 15


@pytest.mark.parametrize("limit", [7, 40])
def test_components_and_rounds_give_the_sequential_rows(spark, monkeypatch, limit):
    rng = random.Random(limit)
    monkeypatch.setattr(dd, "COMPONENT_ROWS", limit)
    monkeypatch.setattr(dd, "ROUNDS", 1)
    rows = [(i, s, u, t) for i, (_, s, u, t) in enumerate(_chain(30, "a") + _chain(9, None))]
    rows += [
        (100 + i, rng.choice(["a", "b", None]), rng.choice(["", None, f"u{rng.randint(0, 30)}"]), f"t{rng.randint(0, 40)}")
        for i in range(80)
    ]
    out = dd.dedupe_greedy(spark.createDataFrame(rows, ROWS).repartition(3), ["scope"])
    assert sorted(r.ord for r in out.collect()) == sequential(rows)
