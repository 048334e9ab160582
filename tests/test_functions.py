from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from martloom.functions import dates, flags, numbers, text


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_placeholders_fall_before_title_case(spark):
    words = ["NA", "na", " N/A ", "null", "None", "-", "", "  ", "nOrTH pole", None]
    assert column(spark, words, text.category) == [None] * 8 + ["North Pole", None]


def test_basket_loses_list_marks_and_empties(spark):
    texts = ["['A', 'B', 'C']", "[]", "", "milk,  bread ,", '"eggs"', None]
    assert column(spark, texts, text.basket) == [["A", "B", "C"], [], [], ["milk", "bread"], ["eggs"], None]


def test_verbatim_basket_keeps_list_marks(spark):
    assert column(spark, ["['A', 'B']", ""], text.basket_verbatim) == [["['A'", "'B']"], [""]]


def test_one_spelling_per_product(spark):
    assert set(column(spark, ["['Milk'", "'milk'", "MILK']", ' "milk"'], text.clean_product)) == {"milk"}


def test_numbers_never_fail(spark):
    assert column(spark, ["7", " 8 ", "12.0", "12.9", "x", "", None, "99999999999"], numbers.to_int) == [
        7, 8, 12, 12, None, None, None, None,
    ]
    assert column(spark, ["1.5", "NaN", "Infinity", "-2", "abc", None], numbers.to_double) == [
        1.5, None, None, -2.0, None, None,
    ]


def test_money_sums_are_exact_and_keep_small_amounts(spark):
    total = numbers.money(F.sum(numbers.exact(F.col("x"))))
    for value, count, expected in ((0.1, 1000, 100.0), (0.004, 5, 0.02), (9e17, 1000, 9e20)):
        assert rows(spark.range(count).select(F.lit(value).alias("x")).agg(total)) == [(expected,)]


def test_amounts_too_large_to_sum_are_told_apart(spark):
    assert column(spark, [5.0, 1e300, 9e17, None], numbers.misfit) == [False, True, False, False]


def test_ratio_of_zero_is_null(spark):
    assert rows(spark.range(1).select(numbers.ratio(F.lit(5), F.lit(0)), numbers.ratio(F.lit(1), F.lit(4), 100.0))) == [
        (None, 25.0)
    ]


def test_timestamp_formats_in_order(spark):
    texts = [
        "2022-01-21 06:27:29",
        "2022-01-21",
        "03-04-2022 01:02:03",
        "03/04/2022 01:02:03",
        "12/25/2022 01:02:03",
        "13-02-2022",
        "02-13-2022",
        "2022/05/06",
        "31-31-2022",
        "soon",
        "",
        None,
    ]
    assert column(spark, texts, dates.parse_timestamp) == [
        datetime(2022, 1, 21, 6, 27, 29),
        datetime(2022, 1, 21),
        datetime(2022, 4, 3, 1, 2, 3),
        datetime(2022, 4, 3, 1, 2, 3),
        datetime(2022, 12, 25, 1, 2, 3),
        datetime(2022, 2, 13),
        datetime(2022, 2, 13),
        datetime(2022, 5, 6),
        None,
        None,
        None,
        None,
    ]


def test_shape_routing_equals_trying_every_format(spark):
    texts = [f"{a}{s}{b}{s}{c}{t}" for a in ("05", "13", "2021") for b in ("06", "14") for c in ("07", "2020", "31")
             for s in "-/." for t in ("", " 01:02:03", " 1:2:3")] + ["+12021-01-01", "2021-1-1"]
    plain = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in dates.TIMESTAMP_FORMATS])
    as_text = lambda make: (lambda c: make(c).cast("string"))
    assert column(spark, texts, as_text(dates.parse_timestamp)) == column(spark, texts, as_text(plain))


def test_named_month_format_still_parses(spark):
    formats = ("yyyy-MM-dd", "dd MMM yyyy")
    assert column(spark, ["05 Mar 2024"], lambda c: dates.parse_timestamp(c, formats)) == [datetime(2024, 3, 5)]


def test_flag_rules(spark):
    words = ["Yes", "TRUE", "1", "no", "False", "0", "maybe", None]
    assert column(spark, words, flags.to_flag) == [True, True, True, False, False, False, None, None]
    typed = lambda c: flags.to_flag(c, flags.TYPED_STAGING_FLAG)
    assert column(spark, words, typed) == [False, True, False, False, False, False, False, False]
    as_text = lambda c: flags.to_flag(c, flags.TEXT_STAGING_FLAG)
    assert column(spark, words, as_text) == [None, True, True, None, False, False, None, None]


def test_calendar_helpers(spark):
    assert column(spark, ["2022-01-21T06:27:29.000Z", "bad", None], dates.leading_date) == [date(2022, 1, 21), None, None]
    assert rows(spark.range(1).select(dates.date_key(F.to_date(F.lit("2022-01-21"))))) == [(20220121,)]
