"""Cache documents read by ranges of bytes give the rows of documents read whole."""

import json

import pytest
from pyspark.sql import functions as F

from pressmill.sources import cache_ranges as cr
from pressmill.sources import day_cache as dc


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20011", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _days(n, prefix="u"):
    def item(day, i):
        return {
            "url": f"{prefix}{day}-{i}",
            "title": 'т}\n    "2020-01-01": {\n  }\n}',
            "text": 'a \\ "quoted" },\n' * 9,
            "matched_keyword": "},",
        }

    keys = [f"20{d // 336:02d}-{d // 28 % 12 + 1:02d}-{d % 28 + 1:02d}" for d in range(n)]
    return {
        k: {"date": k, "links_found": 2, "items": [item(k, i) for i in range(3)] if d % 5 else []}
        for d, k in enumerate(keys)
    }


def _put(root, source, topic, body, name="cache.json"):
    folder = root / source / topic
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(body, encoding="utf-8")


def _dump(value):
    return json.dumps(value, indent=2, ensure_ascii=False)


def _rows(entries):
    got = entries.select("source", "topic", "day", F.to_json("entry").alias("e")).collect()
    return sorted(tuple(r) for r in got)


@pytest.fixture
def cache(tmp_path):
    days = _dump({"days": _days(700)})
    _put(tmp_path, "cbr", "taxes", days)
    _put(tmp_path, "consultant", "taxes", _dump({"reviews": _days(40, "r")}))
    _put(tmp_path, "consultant", "ssem", days)  # another root
    _put(tmp_path, "rbc", "a b{c}", json.dumps({"days": _days(9)}))  # compact
    _put(tmp_path, "rbc", "cut", days[: len(days) // 2])
    _put(tmp_path, "rbc", "middle", days.replace('"links_found": 2', '"links_found": ', 1))
    _put(tmp_path, "rbc", "ended", days.replace("\n    },\n", "\n    }\n  }\n}\n", 1))
    _put(tmp_path, "rbc", "tail", days + "\n")
    _put(tmp_path, "rbc", "more", _dump({"version": 1, "days": _days(3)}))
    _put(tmp_path, "rbc", "after", _dump({"days": _days(3), "version": {"a": {"b": {}}}}))
    _put(tmp_path, "rbc", "none", _dump({"days": {}}))
    _put(tmp_path, "rbc", "empty", "")
    _put(tmp_path, "rbc", "null", _dump({"days": {"2024-01-01": None, 'a"\\b': {"items": []}}}))
    return str(tmp_path)


def test_ranges_give_the_rows_of_whole_documents(spark, cache, small_ranges):
    whole = dc.scan_entries(dc.read_documents(spark, cache))
    got = cr.scan_entries(spark, cache)
    assert _rows(got) == _rows(whole) and len(_rows(got)) > 1400
    proof = {r.file.split("/")[-2]: r.regular for r in cr.prove(cr.read_pieces(spark, cache)).collect()}
    assert proof["tail"] and proof["taxes"]
    assert not any(proof[k] for k in ("cut", "middle", "ended", "more", "after", "none", "null", "ssem"))
    want = {tuple(r) for r in dc.entry_articles(whole).select("url", "day", "pos").collect()}
    assert {tuple(r) for r in dc.entry_articles(got).select("url", "day", "pos").collect()} == want
    few = cr.scan_entries(spark, cache, ["cbr"], ["taxes"])
    assert {r.source for r in few.collect()} == {"cbr"}
    assert cr.scan_entries(spark, cache, ["none"]).count() == 0


def test_one_document_is_read_by_many_tasks(spark, cache, small_ranges):
    pieces = cr.read_pieces(spark, cache, ["cbr"], ["taxes"])
    tasks = pieces.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 4 and pieces.count() == 701


def test_days_are_chosen_before_parsing_with_a_kept_proof(spark, cache, tmp_path, small_ranges):
    kept = str(tmp_path / "proof")
    cr.prove(cr.read_pieces(spark, cache)).write.parquet(kept)
    proof = spark.read.parquet(kept)
    chosen = dict(first_day="2000-03-01", last_day="2000-04-05")
    whole = dc.scan_entries(dc.read_documents(spark, cache)).filter("day between '2000-03-01' and '2000-04-05'")
    assert _rows(cr.scan_entries(spark, cache, proof=proof, **chosen)) == _rows(whole)
    # A file that changed since is proved again.
    _put(tmp_path, "cbr", "taxes", _dump({"days": _days(80)})[:-9])
    again = cr.scan_entries(spark, cache, ["cbr"], proof=proof, **chosen)
    assert again.count() == 0
