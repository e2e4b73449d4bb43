from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import dates, money, rules, text


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def texts(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "t STRING")


def test_locale_number_repairs_and_rejects(spark):
    df = texts(spark, "1.234,56", "7", "-2.000,5", "", "n/a", None)
    assert values(df, text.locale_number("t")) == [1234.56, 7.0, -2000.5, None, None, None]


def test_decimal_comma(spark):
    df = texts(spark, "12,5", "3", "", "x", None)
    assert values(df, text.decimal_comma("t")) == [12.5, 3.0, None, None, None]


def test_parts_by_literal_separator(spark):
    df = texts(spark, "1 - Restaurant", "Restaurant", "a - b - c", "", None)
    assert values(df, text.part("t", " - ", 1)) == ["Restaurant", None, "b", None, None]
    assert values(texts(spark, "a.b"), text.part("t", ".", 1)) == ["b"]
    assert values(texts(spark, "x y z", "one", None), text.last_part("t", " ")) == ["z", "one", None]


def test_zip5(spark):
    df = texts(spark, "27514-0001", "601", "27514", "", "275141", None)
    assert values(df, text.zip5("t")) == ["27514", "00601", "27514", "", "275141", None]


def test_label_keeps_trailing_space_and_null_main(spark):
    df = spark.createDataFrame([("meal", "dinner"), ("meal", None), (None, "x")], "m STRING, s STRING")
    assert values(df, text.label("m", "s")) == ["meal dinner", "meal ", None]


def test_registry_id_is_null_if_any_part_is(spark):
    df = spark.createDataFrame([("NC", "Wake", "1"), ("NC", None, "1")], "a STRING, b STRING, c STRING")
    assert values(df, text.registry_id("a", "b", "c")) == ["NC_Wake_1", None]


def test_dates_reject_instead_of_raising(spark):
    df = texts(
        spark, "2010-05-04", "2010-05-04T00:00:00Z", "2010-05-04 07:08", "2010-05-04T23:59:59.5+02:00",
        "", "x", None, "2010-13-04", "10:00", "2010-05-04 soon",
    )
    assert values(df, dates.parsed_date("t", "yyyy-MM-dd")) == [date(2010, 5, 4)] * 4 + [None] * 6
    df = texts(spark, "04/05/2010 10:00", "04/05/2010")
    assert values(df, dates.parsed_date("t", "dd/MM/yyyy")) == [date(2010, 5, 4)] * 2


def test_iso_week_and_year_around_new_year(spark):
    df = texts(spark, "2024-12-30", "2021-01-03", "2021-01-04").select(F.to_date("t").alias("d"))
    assert values(df, F.weekofyear("d")) == [1, 53, 1]
    assert values(df, dates.iso_year("d")) == [2025, 2020, 2021]


def test_hours_between_rounds_half_up(spark):
    df = spark.createDataFrame(
        [("2020-01-01 00:00:00", end) for end in
         ("2020-01-01 00:00:18", "2020-01-01 00:00:17", "2019-12-31 23:59:42", "2020-01-02 12:00:00", None)],
        "a STRING, b STRING",
    ).select(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert values(df, dates.hours_between("a", "b")) == [
        0.01, 0.0, -0.01, 36.0, None,
    ]


def test_money_is_exact_and_rounds_half_up(spark):
    df = spark.createDataFrame([(0.125,), (0.125,), (None,)], "v DOUBLE")
    assert values(df, money.mean("v")) == [0.13]
    assert values(df, money.total("v")) == [0.25]
    many = spark.range(0, 1000, 1, 7).select(F.lit(0.1).alias("v"))
    assert values(many, money.total("v")) == [100.0]
    assert values(df.where("v IS NULL"), money.mean("v")) == [None]
    assert values(df.where("v IS NULL"), money.total("v")) == [None]


def test_money_keeps_signs_and_small_digits(spark):
    df = spark.createDataFrame([(-1.25,), (-0.75,), (0.000001,), (1e9 + 0.25,)], "v DOUBLE")
    assert values(df, money.exact_sum("v").cast("string")) == ["999999998.250001"]
    assert values(spark.createDataFrame([(-0.125,)], "v DOUBLE"), money.mean("v")) == [-0.13]
    assert values(spark.createDataFrame([(3,), (4,)], "v INT"), money.mean("v")) == [3.5]


def test_rates_survive_zero(spark):
    df = spark.createDataFrame([(1, 4), (0, 4), (1, 0), (None, 4)], "a BIGINT, b BIGINT")
    assert values(df, money.percent("a", "b")) == [25.0, 0.0, None, None]
    assert values(df, money.inverse_ratio("a", "b")) == [4.0, None, None, None]


def test_spending_tier_bounds(spark):
    amounts = [250.01, 250.0, 249.99, 100.01, 100.0, 0.0, None]
    df = spark.createDataFrame([(a,) for a in amounts], "v DOUBLE")
    assert values(df, rules.spending_tier("v")) == [
        "prime", "basic", "normal", "normal", "basic", "basic", "basic",
    ]


def test_rating_class(spark):
    df = texts(spark, "NC-17", "R", "PG-13", "PG", "G", "X", None)
    assert values(df, rules.mapped("t", rules.RATING_CLASS)) == [
        "ADULTS_ONLY", "ADULTS_ONLY", "PARENTAL_GUIDANCE", "PARENTAL_GUIDANCE", "GENERAL", None, None,
    ]


def test_feature_flags_match_whole_entries(spark):
    df = texts(spark, " Trailers,Deleted Scenes ", "Trailer", None)
    flagged = df.select(*rules.feature_flags("t", rules.FILM_FEATURES))
    assert flagged.columns == [
        "feature_trailers", "feature_commentaries", "feature_deleted_scenes", "feature_behind_the_scenes",
    ]
    assert [tuple(r) for r in flagged.collect()] == [(1, 0, 1, 0), (0, 0, 0, 0), (None,) * 4]


@pytest.mark.parametrize("count,good", [(151, True), (150, False), (None, None)])
def test_good_store(spark, count, good):
    df = spark.createDataFrame([(count,)], "c BIGINT")
    assert values(df, rules.good_store("c")) == [good]
