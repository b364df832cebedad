import pytest
from pyspark.sql import functions as F

from stormglass.functions import calendar, news_text
from stormglass.operators import cleaning


def values(spark, function, inputs, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    rows = frame.select("i", function(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def test_archive_title(spark):
    cases = {
        "https://x.example/a/military-strike-near-border.html": "Military Strike Near Border",
        "https://x.example/a/peace_talks_resume_in_capital/": "Peace Talks Resume Capital",
        "https://x.example/a/2024-storm-warning-99issued?id=4": "Storm Warning Issued",
        "https://x.example/a/short.html": None,
        "https://x.example/abcdef-ghijklmn.html": None,  # 15 characters
        "https://x.example/abcdefg-ghijklmn.html": "Abcdefg Ghijklmn",  # 16 characters
        "https://x.example/UPPER-CASE-HEADLINE.html": "Upper Case Headline",
        "https://x.example/a-b-c-d-ab-cd": None,
        "": None,
        None: None,
    }
    assert values(spark, news_text.url_to_title, list(cases)) == list(cases.values())


def test_live_title(spark):
    cases = [
        "https://x.example/covid19vaccine-doesn't_work.html",
        "https://x.example/NATO-meets/",
        "https://x.example/.html",
        "https://x.example/" + "long-word-" * 10,
    ]
    assert values(spark, news_text.url_to_title_live, cases) == [
        "Covid19Vaccine Doesn'T Work", "Nato Meets", "https://x.example/.html",
        ("Long Word " * 10)[:60],
    ]


@pytest.mark.parametrize("text", ["o'neil 3rd-party", "ÉCOLE über alles", "a1b2c3 x_y", "word  two"])
def test_title_case_is_that_of_python(spark, text):
    assert values(spark, news_text.capitalise_after_non_letters, [text]) == [text.title()]


def test_category_is_the_first_match_by_substring(spark):
    themes = ["SANCTION;MILITARY", "AWARD", "TARIFF", "RIOT", "EXPULSION", "CEASEFIRE", "ESPIONAGE",
              "NUCLEAR", "SPORTS", "military", None]
    assert values(spark, news_text.batch_category, themes) == [
        "CONFLICT", "CONFLICT", "ECONOMIC_PRESSURE", "POLITICAL_INSTABILITY", "DIPLOMATIC_TENSION",
        "DEESCALATION", "INTELLIGENCE_CYBER", "SPECIAL", None, None, None,
    ]
    assert values(spark, news_text.live_category, themes) == [
        "Military", "Military", "Sanctions", "Other", "Diplomatic", "Other", "Other", "Nuclear",
        "Other", "Other", "Other",
    ]


def test_foreign_country(spark):
    themes = ["x#US#", "x#RS#", "x#UP#US#", "x#usa#", "x#U#", None]
    assert values(spark, news_text.mentions_foreign_country, themes) == [
        False, True, True, False, False, None
    ]


def test_tone_and_dates_give_null_instead_of_errors(spark):
    assert values(spark, news_text.negative_tone, ["0,1,5.5,0", "0,1", "a,b,c", "", None]) == [
        5.5, None, None, None, None
    ]
    days = values(spark, calendar.news_date, ["20160131120000", "20160231", "2022", "2016013x", None])
    assert [str(d) if d else None for d in days] == ["2016-01-31", None, None, None, None]


def test_epoch_nanoseconds(spark):
    midnight = 1_451_606_400_000_000_000  # 2016-01-01
    days = values(spark, calendar.epoch_ns_to_date, [midnight, midnight - 1000, None], "bigint")
    assert [str(d) if d else None for d in days] == ["2016-01-01", "2015-12-31", None]


def test_market_hours_follow_daylight_saving(spark):
    frame = spark.sql("""
        SELECT * FROM VALUES (1, timestamp '2024-01-05 14:29:59'), (2, timestamp '2024-01-05 14:30:00'),
          (3, timestamp '2024-01-05 20:59:59'), (4, timestamp '2024-01-05 21:00:00'),
          (5, timestamp '2024-01-06 15:00:00'), (6, timestamp '2024-07-05 13:30:00') AS t(i, ts)""")
    rows = frame.select("i", calendar.market_open(F.col("ts")).alias("o")).collect()
    assert {r["i"]: r["o"] for r in rows} == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True}


def test_title_filters(spark):
    titles = [
        "Military Strike Near Border Town", "Protest Threat Grows Decade Long", "abc def 123",
        "Visit News.com For Latest Headlines", "Article Some Words And More Text",
        "12345 67890 12345 67890 12345", "deadbeef deadbeef deadbeef",
    ]
    frame = spark.createDataFrame([(t,) for t in titles], "title string")

    def kept(function):
        return {r["title"] for r in function(frame).collect()}

    assert kept(cleaning.filter_title_quality_archive) == {titles[0]}
    assert kept(cleaning.filter_title_quality_feed) == {titles[0], titles[4]}
    assert kept(cleaning.filter_title_quality_live) == {titles[0], titles[1], titles[3], titles[4]}


def test_relevance(spark):
    cases = [
        ("Iran Missile Launch Reported", "Iran War", True),
        ("Iran Wins Football Match", "Iran War", False),  # no conflict word
        ("Missile Launch Reported", "Iran War", False),  # no proper noun
        ("Anything At All", "War Escalation", True),  # no proper noun in the label
        (None, "War Escalation", False),
        ("Big Event Protest", "Geopolitical Event", True),
    ]
    frame = spark.createDataFrame([c[:2] for c in cases], "title string, label string")
    kept = {(r["title"], r["label"]) for r in cleaning.filter_news_relevance(frame).collect()}
    assert kept == {c[:2] for c in cases if c[2]}


def test_theme_filter_ignores_case(spark):
    frame = spark.createDataFrame([("military",), ("Sports",), (None,)], "themes string")
    assert [r["themes"] for r in cleaning.filter_theme_keywords(frame).collect()] == ["military"]
