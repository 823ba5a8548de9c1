import datetime as dt
import hashlib

from pyspark.sql import functions as F

from forumlake.constants import NULL_KEY_MARKER
from forumlake.functions import date_key, date_spine, surrogate_key, url_host, whole_units
from forumlake.sources.silver import parse_items


def test_url_host_cuts_text(spark):
    expected = {
        "https://a.com/x": "a.com",
        "http://www.a.com?y": "www.a.com",
        "android-app://p/q": "p",
        "https://u@h.com:80/x": "u@h.com:80",
        "A.com": "A.com",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in expected], "url string")
    assert dict(df.select("url", url_host("url")).collect()) == expected


def test_surrogate_key(spark):
    row = spark.sql("SELECT 12 AS a, CAST(NULL AS string) AS b").select(
        surrogate_key("a"), surrogate_key("b"), surrogate_key("a", "b"), surrogate_key(F.lit(""))
    )
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert tuple(row.first()) == (md5("12"), md5(NULL_KEY_MARKER), md5(f"12-{NULL_KEY_MARKER}"), md5(""))


def test_whole_units_cut_toward_zero(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:59'),
        (timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:01:00'),
        (timestamp'2024-01-01 00:00:59', timestamp'2024-01-01 00:00:00'),
        (timestamp'2024-01-01 00:01:30', timestamp'2024-01-01 00:00:00'),
        (timestamp'2024-01-01 23:30:00', timestamp'2024-01-02 22:30:00'),
        (timestamp'2024-01-01 23:30:00', timestamp'2024-01-02 23:30:00') AS t(a, b)"""
    )
    got = [tuple(r) for r in df.select(whole_units("MINUTE", "a", "b"), whole_units("DAY", "a", "b")).collect()]
    assert got == [(0, 0), (1, 0), (0, 0), (-1, 0), (1380, 0), (1440, 1)]


def test_dates(spark):
    spine = date_spine(spark, "2006-01-01", "2026-12-31")
    first, last, n = spine.agg(F.min("date_day"), F.max("date_day"), F.count("date_day")).first()
    assert (first, last, n) == (dt.date(2006, 1, 1), dt.date(2026, 12, 30), 7669)
    assert spark.sql("SELECT timestamp'2025-10-05 23:59:59' AS t").select(date_key("t")).first()[0] == 20251005


def test_parse_is_strict_and_keeps_every_line(spark):
    lines = {
        "story": '{"id":1,"type":"story","by":"ann","time":1700000000,"title":"[pdf] x","text":null,"url":"http://a","score":3}',
        "comment": '{"id":2,"type":"comment","by":"bob","parent":1,"text":"hi"}',
        "broken": "{bad",
        "cut off": '{"id":3,"title":"x',
        "blank": "",
        "none": None,
        "text id": '{"id":"12"}',
        "fraction id": '{"id":1.5}',
        "boolean id": '{"id":true}',
        "exponent id": '{"id":1e3}',
        "huge id": '{"id":12345678901234567890}',
        "object title": '{"id":4,"title":{"a":1}}',
        "array title": '{"id":5,"title":["a"]}',
        "text like object": '{"id":6,"title":"{\\"a\\":1}"}',
        "delimiter": '{"id":7,"title":"a § b"}',
        "text after": '{"id":8} trailing',
        "array line": '[{"id":9}]',
        "two objects": '{"id":11} {"id":12}',
        "text with brace after": '{"id":13} x}',
        "brace too many": '{"id":14}}',
        "two with comma": '{"id":15},{"id":16}',
        "closed field": '{"id":17},"w":{"id":18}',
        "single quotes": "{'id':19}",
        "white space": ' \t{"id":20 } ',
        "repeated key": '{"id":21,"id":22}',
        "absurd time": '{"id":10,"time":99999999999999999}',
    }
    df = spark.createDataFrame([(v, k, "2025-10-05") for k, v in lines.items()], "value string, source_file string, ingest_date string")
    parsed = {r.source_file: r for r in parse_items(df).collect()}
    assert parsed.keys() == lines.keys()
    ids = {k: r.item_id for k, r in parsed.items()}
    assert ids == {
        "story": 1, "comment": 2, "broken": None, "cut off": None, "blank": None, "none": None, "text id": 12,
        "fraction id": None, "boolean id": None, "exponent id": None, "huge id": None, "object title": 4,
        "array title": 5, "text like object": 6, "delimiter": 7, "text after": None, "array line": None, "absurd time": 10,
        "two objects": None, "text with brace after": None, "brace too many": None, "two with comma": None,
        "closed field": None, "single quotes": None, "white space": 20, "repeated key": 22,
    }
    story = parsed["story"]
    assert (story.title, story.text_content, story.created_at) == ("[pdf] x", None, story.created_at)
    assert story.ingest_date_str == "2025-10-05" and story.score == 3
    assert parsed["object title"].title is None and parsed["array title"].title is None
    assert parsed["text like object"].title == '{"a":1}'
    assert parsed["delimiter"].title == "a § b"
    assert parsed["absurd time"].created_at is None
    assert parsed["comment"].parent_id == 1
