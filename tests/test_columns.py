import datetime

import pytest
from pyspark.sql import functions as F

from pressmill.functions import dates as dt
from pressmill.functions import replies as rp
from pressmill.functions import text as tx
from pressmill.operators import articles as ar
from pressmill.operators import windows as wn
from pressmill.schema import SOURCES, TOPICS


def values(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_format_news_date(spark):
    cases = {
        "2024-03-05": "05.03.2024",
        "at 2024/03/05 10:00": "05.03.2024",
        "2024-99-77": "77.99.2024",
        "12024-03-05": "12024-03-05",
        "5.3.2024": "05.03.2024",
        "15.03.2024, 10:00": "15.03.2024",
        " 5 марта 2024 г.": "05.03.2024",
        "5 Марта 2024": "05.03.2024",
        "5 мартобря 2024": "5 мартобря 2024",
        " soon ": "soon",
        "": "",
        None: "",
    }
    assert values(spark, list(cases), dt.format_news_date) == list(cases.values())


def test_parse_news_date(spark):
    day = datetime.date(2024, 3, 5)
    cases = {
        "5.3.2024": day,
        "2024-03-05T10:00": day,
        "2024/03/05": day,
        "1.1.2023 2024-03-05": datetime.date(2023, 1, 1),
        "31.02.2024 2024-03-05": None,
        "2024-02-30": None,
        "5 марта 2024": None,
        "nan": None,
        None: None,
    }
    assert values(spark, list(cases), dt.parse_news_date) == list(cases.values())


@pytest.mark.parametrize(
    "style,cases",
    [
        (
            "mail",
            {
                "Tue, 05 Mar 2024 23:30:00 +0300": (2024, 3, 5),
                "5 Mar 24 23:30 GMT": (2024, 3, 5),
                "Tue, 05 Mar 1999 23:30:00": (1999, 3, 5),
                "05.03.2024": (2024, 3, 5),
                "2024-03-05": (2024, 3, 5),
                "Tue, 31 Feb 2024 10:00:00 +0000": None,
                "later": None,
                "": None,
            },
        ),
        (
            "short_dotted",
            {
                "05.03.24": (2024, 3, 5),
                "05.03.2024": (2024, 3, 5),
                "5.3.99": (1999, 3, 5),
                "05.03.2410:30": (2024, 3, 5),
                "05.03.202410:30": (2024, 3, 5),
                "Новость 05.03.24 и 06.03.2024": (2024, 3, 5),
                "05.03.2024 Новость": (2024, 3, 5),
                "32.03.24": None,
                "2024-03-05": None,
            },
        ),
        (
            "long_dotted",
            {
                "05.03.2024": (2024, 3, 5),
                " 05.03.2024 10:30 ": (2024, 3, 5),
                "5.3.2024": None,
                "05.03.2024 25:00": None,
                "2024-03-05": None,
            },
        ),
        (
            "iso_prefix",
            {
                "2024-03-05": (2024, 3, 5),
                "2024-03-05T10:00:00+03:00": (2024, 3, 5),
                "05.03.2024": None,
                "2024-13-05": None,
                "": None,
            },
        ),
        (
            "named_month",
            {
                "5 марта 2024": (2024, 3, 5),
                "05 Марта 2024 года": (2024, 3, 5),
                "5 марта": None,
                "31 февраля 2024": None,
                "марта 5 2024": None,
            },
        ),
    ],
)
def test_parse_source_date(spark, style, cases):
    expected = [datetime.date(*v) if v else None for v in cases.values()]
    assert values(spark, list(cases), lambda c: dt.parse_source_date(c, style)) == expected


def test_text_helpers(spark):
    assert values(spark, ["  a \n b\x1c", None], tx.normalize_whitespace) == ["a b", ""]
    assert values(spark, [" http://x/a/// ", "/", None], tx.url_key) == ["http://x/a", "", ""]
    assert values(spark, ["https://www.a.b:80/c?d", "//x.y/z", "x", None], tx.url_domain) == ["a.b:80", "x.y", "", ""]
    cells = ["", None, " one, two ", "['a', \"b\", '', c]", "[]", "[ ]", "["]
    assert values(spark, cells, tx.keyword_list) == [[], [], ["one, two"], ["a", "b", "c"], [], [], ["["]]
    links = ["/a", "b", "https://o/c", "//h/d", ""]
    base = "https://s.x/n/list?p=1"
    assert values(spark, links, lambda c: tx.resolve_url(c, base)) == [
        "https://s.x/a", "https://s.x/n/b", "https://o/c", "https://h/d", base,
    ]
    assert values(spark, ["d"], lambda c: tx.resolve_url(c, "https://s.x")) == ["https://s.x/d"]


def test_clean_profiles(spark):
    banki = tx.CLEAN_PROFILES["banki"]
    assert values(spark, ["a b\n Читать по теме: c", "x "], lambda c: tx.strip_boilerplate(c, banki)) == ["a b", "x"]
    interfax = tx.CLEAN_PROFILES["interfax"]
    raw = ["Title\nMoscow. INTERFAX.RU - Text  here", "Other INTERFAX.RU - t"]
    assert values(spark, raw, lambda c: tx.strip_boilerplate(c, interfax, F.lit("Title"))) == ["Text here", "t"]
    nalog = tx.CLEAN_PROFILES["nalog"]
    raw = ["Дата публикации: 05.03.2024 10:30 a&nbsp;b &quot;c  ", "Дата публикации: 05.03.2024 Текст"]
    assert values(spark, raw, lambda c: tx.strip_boilerplate(c, nalog)) == ["10:30 a b c", "Текст"]


def test_prompt_is_filled_once(spark):
    df = spark.createDataFrame([("t", "{text}", " body ")], "topic string, title string, text string")
    fields = {"title": F.col("title"), "text": F.col("text")}
    made = tx.prompt_for_topic(F.col("topic"), {"t": "<{title}|{text}|{other}>"}, fields, 3)
    assert df.select(made.alias("p")).first().p == "<{text}|bod|{other}>"


def test_topic_aliases(spark):
    names = [" ЦК по налогам ", "ССЭМ", "payment_systems", "другое", None]
    assert values(spark, names, ar.normalize_topic) == ["taxes", "ssem", "payment_systems", "другое", ""]


def test_dimensions():
    assert len(SOURCES) == len({s.id for s in SOURCES}) == len({s.order for s in SOURCES}) == 10
    assert [s.id for s in SOURCES if s.root_key == "reviews"] == ["consultant"]
    assert {s.id for s in SOURCES if s.key_format} == {"interfax", "kommersant"}
    assert [t.id for t in TOPICS] == ["payment_systems", "ssem", "taxes"]


def test_day_windows(spark):
    today = F.lit("2026-07-05").cast("date")
    slash = lambda c: wn.in_source_window(c, "yyyy/MM/dd", 30, today)
    dash = lambda c: wn.in_source_window(c, "yyyy-MM-dd", 30, today)
    rest = lambda c: wn.in_source_window(c, "", 30, today)
    assert values(spark, ["2026/07/05", "2026-07-05", "2026/06/06", "2026/06/05", "2026/07/06"], slash) == [
        True, False, True, False, False,
    ]
    assert values(spark, ["2026-07-05", "2026/07/05", "2026-7-5"], dash) == [True, False, False]
    assert values(spark, ["2026-07-01", "2026-05-01", "2026-06-05", "2026-06-04", "2026-08-01", "x", None], rest) == [
        True, False, True, False, True, False, False,
    ]


def test_scores_and_flags(spark):
    texts = ["85", " 59.9 ", "1e3", "-4", "bad", "", None, "nan", "0x1", "7d"]
    assert values(spark, texts, rp.clean_score) == [85, 59, 100, 0, 0, 0, 0, 0, 0, 0]
    assert values(spark, ["1", " Да ", "yes", "TRUE", "0", "", None], rp.as_bool) == [True] * 4 + [False] * 3


def test_categories_carry_forward(spark):
    lines = ["x" * 40, "# TAX news", "a" * 40, "short", "# none", "b" * 40, "# bank", "c" * 31, "# TAX", "d" * 31]
    df = spark.createDataFrame([(lines,)], "l array<string>")
    out = df.select(ar.category_lines(F.col("l"), ("tax", "bank"), "^#").alias("e")).first().e
    assert [(e.pos, e.category) for e in out] == [(2, "tax"), (7, "bank"), (9, "tax")]
