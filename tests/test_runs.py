"""Export, enrich and rank on a small cache in the usual file layout."""

import json

from pyspark.sql import functions as F

from pressmill.functions.text import embedding_text
from pressmill.operators.periods import PeriodStore
from pressmill.operators.similarity import hashed_vectors
from pressmill.plans import runs
from pressmill.session import work_path
from pressmill.sources import day_cache as dc


def _cache(root, source, topic, key, days):
    folder = root / source / topic
    folder.mkdir(parents=True, exist_ok=True)
    entries = {
        day: {"date": day, "items": [dict(zip(("url", "title", "text", "matched_keyword"), i), date=day) for i in items]}
        for day, items in days.items()
    }
    (folder / "cache.json").write_text(json.dumps({key: entries}, ensure_ascii=False), encoding="utf-8")


def _export(spark, root, store):
    docs = dc.read_documents(spark, str(root))
    ids = ["cbr", "interfax", "consultant"]
    return runs.export_run(docs, store, ids, ["taxes", "ssem"], 5, F.lit("2024-03-10").cast("date"))


def test_three_runs(spark, tmp_path):
    store = PeriodStore(spark, work_path(spark, "period"))
    words = "налог на прибыль банка вырастет с января по решению минфина"
    _cache(tmp_path, "cbr", "taxes", "days", {
        "2024-03-09": [("u1/", "A", words, "k1"), ("u2", "B", "другое дело совсем", "k2")],
        "2024-03-10": [("u1/", "A2", "повтор", "k3")],
        "2024-03-04": [("old", "Old", "мимо окна", "")],
    })
    _cache(tmp_path, "interfax", "taxes", "days", {
        "2024/03/08": [("u3", "A", words, "k1"), ("u4", "D", "сбой", "k4")],
        "2024-03-08": [("u5", "bad key", "x", "")],
    })
    _cache(tmp_path, "consultant", "ssem", "reviews", {"2024-03-05": [("u6", "E", "обзор", "k6")]})
    _cache(tmp_path, "consultant", "taxes", "days", {"2024-03-05": [("u7", "wrong root", "x", "")]})

    period = _export(spark, tmp_path, store).collect()
    got = {(r.url, r.title, r.news_date, r.source, r.topic, r.keywords) for r in period}
    assert got == {
        ("u1/", "A2", "10.03.2024", "Центробанк", "Налоги", "k3"),
        ("u2", "B", "09.03.2024", "Центробанк", "Налоги", "k2"),
        ("u3", "A", "08.03.2024", "Interfax", "Налоги", "k1"),
        ("u4", "D", "08.03.2024", "Interfax", "Налоги", "k4"),
        ("u6", "E", "05.03.2024", "Consultant", "ССЭМ", "k6"),
    }
    assert _export(spark, tmp_path, store).count() == 5

    _cache(tmp_path, "interfax", "taxes", "days", {"2024/03/10": [("u8", "A", words, "k8"), ("u1", "again", "y", "")]})
    assert {r.url for r in _export(spark, tmp_path, store).collect()} == {"u1/", "u2", "u3", "u4", "u6", "u8"}

    table = work_path(spark, "scores")

    def scorer(prompts):
        out = []
        for text in prompts:
            score = 90 if "минфин" in text else 65 if "повтор" in text else 10
            out.append(RuntimeError("503") if text == "сбой" else json.dumps({"score": score, "topic": "t", "summary": text}))
        return out

    def embed(rows):
        texts = rows.select("row_id", embedding_text(F.col("title"), F.col("summary"), F.col("text")).alias("t"))
        return hashed_vectors(texts, "row_id", "t")

    enriched = runs.enrich_run(store, table, scorer, F.col("text"), embed, waves=2).collect()
    by_url = {r.url: r for r in enriched}
    # u3 and u8 tell the same; the earlier row of equal score stays.
    assert set(by_url) == {"u1/", "u2", "u3", "u4", "u6"}
    assert by_url["u4"].reason.startswith("Ошибка LLM scoring:") and by_url["u4"].score == 0
    assert by_url["u6"].topic_id == "ssem" and not by_url["u6"].is_top

    retry = runs.enrich_run(store, table, lambda p: ['{"score": 70, "summary": "fixed"}'] * len(p), F.col("text"), waves=1)
    now = {r.url: r.score for r in retry.collect()}
    assert now["u4"] == 70 and now["u3"] == 90 and len(now) == 5

    rows = store.read_open()
    ranked = {r.url: (r.top_rank, r.is_top) for r in runs.rank_run(rows, top_n=2, reserve_n=1).collect()}
    assert ranked == {"u3": (1, True), "u4": (2, True), "u1/": (3, False), "u2": (None, False), "u6": (None, False)}

    def ranker(topic, payload):
        ids = [item["row_id"] for item in json.loads(payload)]
        return json.dumps({"ranked_top15": [{"rank": n + 1, "row_id": i} for n, i in enumerate(reversed(ids))]})

    asked = runs.rank_run(rows, ranker, top_n=1, only_topic="Налоги")
    assert {r.url: (r.top_rank, r.is_top) for r in asked.collect() if r.top_rank} == {
        "u1/": (1, True), "u4": (2, False), "u3": (3, False),
    }
    kept = runs.rank_run(asked, top_n=1, only_topic="ssem").collect()
    assert sum(r.is_top for r in kept) == 1


def test_one_failing_prompt_fails_alone(spark):
    from pressmill.operators.scoring import score_rows

    def scorer(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("refused")
        return ['{"score": 70, "is_candidate": true}' for _ in prompts]

    rows = spark.createDataFrame([(i, "taxes", "bad" if i == 4 else "good") for i in range(10)], "id long, topic string, p string")
    got = {r.id: r.score for r in score_rows(rows, "id", scorer, F.col("p")).collect()}
    assert got == {i: 0 if i == 4 else 70 for i in range(10)}


def test_documents_of_one_source_and_topic_are_told_apart(spark, tmp_path):
    docs = [("f", "cbr", "taxes", '{"days": {"2024-03-09": {"items": [{"url": "u%s", "title": "T%d"}]}}}' % (u, i))
            for i, u in enumerate("aab")]
    df = spark.createDataFrame(docs, "file string, source string, topic string, body string")
    kept = runs.cached_articles(df, None, ["taxes"], 5, F.lit("2024-03-10").cast("date"))
    assert sorted(r.url for r in kept.collect()) == ["ua", "ub"]
