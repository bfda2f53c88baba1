import pytest
from pyspark.sql import functions as F

from lunario import schema
from lunario.functions import (
    gdp_number,
    index_number,
    lenient_timestamp,
    month_of_abbreviation,
    normalise_period_part,
    period_label,
    strict_date,
)

MONTHS = "Ene Feb Mar Abr May Jun Jul Ago Sep Oct Nov Dic".split()


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_month_names_in_any_case(spark):
    texts = MONTHS + [m.upper() for m in MONTHS] + [f" {m.lower()} " for m in MONTHS] + [None]
    assert values(spark, texts, month_of_abbreviation) == [*range(1, 13)] * 3 + [None]


def test_unknown_month_name(spark):
    assert values(spark, ["Foo"], lambda c: month_of_abbreviation(c, strict=False)) == [None]
    with pytest.raises(Exception, match="unknown month name"):
        values(spark, ["Foo"], month_of_abbreviation)


def test_gdp_numbers(spark):
    cases = {
        "55.059.326": 55059326,
        "589.162.366": 589162366,
        "112.152.352": 112152352,
        "6.795.359": 6795359,
        "100": 100,
        None: None,
    }
    assert values(spark, list(cases), gdp_number) == list(cases.values())
    with pytest.raises(Exception, match="cannot repair number"):
        values(spark, [""], gdp_number)
    assert values(spark, ["", "x"], lambda c: gdp_number(c, strict=False)) == [None, None]


def test_index_numbers_of_every_branch(spark):
    cases = {
        "105.885.915": 105.885,
        "101.540.937": 101.54,
        "103.244.622": 103.244,
        "11.737.952": 117.37,
        "976.113.405": 97.6,
        "888.267.283": 88.8,
        "93.851.301": 93.851,
        "9.371.354": 93.71,
        "976": 97.6,
        None: None,
    }
    assert values(spark, list(cases), index_number) == list(cases.values())


@pytest.mark.parametrize("broken", ["100", "1", "88", ""])
def test_index_number_without_second_group(spark, broken):
    assert values(spark, [broken], lambda c: index_number(c, strict=False)) == [None]
    with pytest.raises(Exception, match="cannot repair number"):
        values(spark, [broken], index_number)


def test_lenient_dates(spark):
    cases = {
        "2013-01-01": "2013-01-01",
        "2013-01-01 00:00:00 UTC": "2013-01-01",
        "2013/2/03": "2013-02-03",
        "20130405": "2013-04-05",
        "02/03/2014": "2014-02-03",
        "13/03/2014": "2014-03-13",
        "25-12-2014": "2014-12-25",
        "2020-13-01": None,
        "garbage": None,
        None: None,
    }
    got = values(
        spark, list(cases), lambda c: F.date_format(lenient_timestamp(c), "yyyy-MM-dd")
    )
    assert got == list(cases.values())


def test_strict_date(spark):
    assert str(values(spark, ["2014-02-28"], strict_date)[0]) == "2014-02-28"
    with pytest.raises(Exception, match="not a yyyy-MM-dd date"):
        values(spark, ["28/02/2014"], strict_date)


def test_period_label_is_not_padded(spark):
    row = spark.sql("SELECT 2014.0D AS a, 2 AS m").select(period_label(F.col("a"), F.col("m")))
    assert row.first()[0] == "2014-2"


def test_period_arguments(spark):
    assert values(spark, ["03", " 3", "", None, "x"], normalise_period_part) == [
        "3",
        "3",
        None,
        None,
        "x",
    ]


def test_column_arithmetic():
    full = schema.FULL
    assert len(full.merged) + 1 == 50
    assert len(full.values) == 47
    assert len(full.features) == 141
    assert len(full.features) + 1 == 142
    assert len(full.request().fields[1].dataType.fields) == 49
