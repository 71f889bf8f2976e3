import pytest
from pyspark.sql import functions as F

from pressmill.functions import replies as rp
from pressmill.operators import ranking as rk
from pressmill.operators import scoring as sc
from pressmill.operators.quality import MissingColumns
from pressmill.schema import Topic
from pressmill.session import work_path

CASES = [
    ('{"score": 70, "summary": "s"}', "object", {"score": "70", "summary": "s"}),
    ('```json\n{"score": 1}\n```', "object", {"score": "1"}),
    ('<think>{"score": 2}</think> {"score": 3}', "object", {"score": "3"}),
    ('Answer: {"a": {"b": 1}, "score": 4} and {"score": 5}', "embedded", {"a": '{"b":1}', "score": "4"}),
    ('{bad} {"summary": "x", "score": 6} {"summary": "y", "score": 7} {', "summary_score", {"summary": "y", "score": "7"}),
    ('{bad} {"summary": "x", "k": true} {', "summary", {"summary": "x", "k": "true"}),
    ('{"summary": "he said "no"\nthen", "score": 8, "r": }', "pulled", {"summary": 'he said "no" then', "score": "8"}),
    ('[{"score": 9}]', "none", None),
    ("nothing", "none", None),
    ("", "none", None),
    (None, "none", None),
]


def test_parse_reply(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, reply string")
    parsed = df.select("i", rp.parse_reply(rp.reply_text(F.col("reply"))).alias("p")).orderBy("i").collect()
    got = [(r.p.found_by, r.p.fields) for r in parsed]
    assert got == [(c[1], c[2]) for c in CASES]


def test_candidate_flag_defaults_to_the_score(spark):
    replies = ['{"score": 60}', '{"score": 59}', '{"score": 90, "is_candidate": false}', '{"score": 90, "is_candidate": null}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, reply string")
    out = sc.parse_replies(df).orderBy("i").collect()
    assert [r.is_candidate for r in out] == [True, False, False, False]


TOPICS = (Topic("t", "T", ("Tee",)), Topic("u", "U"))


def _rows(spark):
    rows = [(1, "Tee", "good"), (2, "t", "fail"), (3, "x", "good"), (4, "u", "good"), (5, "t", "junk")]
    return spark.createDataFrame(rows, "id long, topic string, text string")


def _scorer(prompts):
    if "crash" in prompts:
        raise RuntimeError("down")
    answers = {"good": '{"score": 80, "topic": "s"}', "junk": "??", "fail": ValueError("503")}
    return [answers[p] for p in prompts]


def test_scoring_error_rows_unknown_topics_and_filter(spark):
    out = sc.score_rows(_rows(spark), "id", _scorer, F.col("text"), TOPICS, only_topic="Tee").collect()
    got = {r.id: (r.topic_id, r.score, r.is_candidate, r.subject, r.reason) for r in out}
    assert got[1] == ("t", 80, True, "s", "")
    assert got[2] == ("t", 0, False, "not_relevant", sc.ERROR_PREFIX + " 503")
    assert got[3] == ("x", 0, False, "not_relevant", sc.UNKNOWN_TOPIC + "x")
    assert got[5][4].startswith(sc.ERROR_PREFIX)
    assert set(got) == {1, 2, 3, 5}


def test_scoring_resumes_where_it_failed(spark):
    rows, table = _rows(spark), work_path(spark, "scores")
    sc.score_in_waves(rows, "id", table, _scorer, F.col("text"), waves=3, topics=TOPICS)
    held = sc.read_scores(spark, table, "id", rows)
    pending = sc.resume_unscored(rows, held, "id").collect()
    assert sorted(r.id for r in pending) == [2, 5]
    sc.score_in_waves(
        rows, "id", table, lambda p: ['{"score": 61}'] * len(p), F.col("text"), waves=1, topics=TOPICS
    )
    now = sc.current_scores(sc.read_scores(spark, table, "id", rows), "id").collect()
    assert {r.id: r.score for r in now} == {1: 80, 2: 61, 3: 0, 4: 80, 5: 61}


def test_gates(spark):
    df = spark.createDataFrame([(1, "t")], "ord long, topic string")
    with pytest.raises(MissingColumns, match="score"):
        sc.prepare_ranking(df)
    with pytest.raises(MissingColumns):
        rk.global_topk(df, 3, ["ord"])


def test_ranking_reply(spark):
    reply = '{"ranked_top15": [{"rank": 1, "row_id": 5}, {"rank": "2", "row_id": "6"}, {"rank": 0, "row_id": 7}, {"rank": 3, "row_id": 5}]}'
    ranks = rk.ranks_from_replies(spark.createDataFrame([("t", reply), ("u", "{}")], "topic string, reply string"))
    assert {(r.topic, r.row_id, r["rank"]) for r in ranks.collect()} == {("t", 5, 3), ("t", 6, 2)}
    rows = spark.createDataFrame([(5, "t", 9), (6, "u", 9)], "ord long, topic string, top_rank int")
    out = rk.apply_ranking(rows, ranks, top_n=3).collect()
    assert {(r.ord, r.top_rank, r.is_top) for r in out} == {(5, 3, True), (6, None, False)}
