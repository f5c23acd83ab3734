import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listora.functions.hours import days_open
from listora.functions.phones import to_e164
from listora.functions.text import not_blank, present, sorted_tokens, title_words, trim_ws
from listora.operators.clean import category_normalized, clean, email_normalized, email_syntax_valid
from listora.operators.normalize import coerce_types, rename_columns, to_boolean, to_number, to_time
from listora.settings import Settings


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_email(spark):
    values = ["Test@Example.com", "not-an-email", None, "  ", " a@b.c ", "a@b@c.d", "a b@c.d"]
    assert column(spark, values, email_normalized) == [
        "test@example.com", None, None, None, "a@b.c", None, None,
    ]
    assert column(spark, values, email_syntax_valid) == [
        True, False, False, False, True, False, False,
    ]


def test_category(spark):
    values = ["  drug rehab center  ", None, " ", "psychotherapeut/in", "o'neil x2y", "ÄRZTEHAUS"]
    assert column(spark, values, category_normalized) == [
        "Drug Rehab Center", None, None, "Psychotherapeut/In", "O'Neil X2Y", "Ärztehaus",
    ]


def test_title_words_follow_python(spark):
    values = ["a\u0001 b", "\u0001 a", "中a b", "straße 12b", "MÜLLER-lüdenscheidt", "", "3rd x"]
    assert column(spark, values, title_words) == [v.title() for v in values]


def test_short_names_are_dropped(spark):
    df = spark.createDataFrame(
        [("AB", 4.5, 52.5, "rehab"), ("Valid Business Name", 5.0, 53.5, "clinic"), (None, 3.0, 91.0, "c")],
        "name string, score double, lat double, category string",
    )
    df = df.withColumns({"phone": F.lit(None).cast("string"), "email": F.lit(None).cast("string")})
    rows = clean(df, Settings(min_name_length=3)).collect()
    assert [r.name for r in rows] == ["Valid Business Name"]


def test_latitude_out_of_range_is_cleared(spark):
    df = spark.createDataFrame([("Business A", 95.0, 4.0)], "name string, lat double, score double")
    row = clean(df, Settings(min_name_length=1)).first()
    assert row.lat is None and row.score == 4.0


def test_white_space_is_python_white_space(spark):
    values = ["  x \n", "\x1fx\x1c", "x", " ", None, "​x"]
    assert column(spark, values, trim_ws) == [None if v is None else v.strip() for v in values]
    assert column(spark, values, not_blank) == [bool(v and v.strip()) for v in values]
    assert column(spark, values, sorted_tokens) == [
        None if v is None else " ".join(sorted(v.split())) for v in values
    ]


def test_present(spark):
    values = ["x", "", None, "nan", "NaN", " nan ", "nano", " ", "nan\n", "\n a"]
    wanted = [bool(v is not None and v.strip() != "" and v.lower() != "nan") for v in values]
    assert column(spark, values, present) == wanted


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("+49 30 1234567", "+49301234567"), ("030/1234567", "+49301234567"),
        ("0049 (30) 1234567", "+49301234567"), ("+49 (0)30 1234567", "+49301234567"),
        ("+49 030 1234567", "+49301234567"), ("30 1234567", "+49301234567"),
        ("Tel. 030 1234567 ext. 12", "+49301234567"), ("+43 1 234567", "+431234567"),
        ("call us", None), ("12", None), (None, None), ("", None),
        ("+49 123456789012345", None), ("12345", None), ("+1 555 0100", None), ("+1 (212) 555-0100", "+12125550100"),
    ],
)
def test_phone(spark, raw, wanted):
    assert column(spark, [raw], lambda c: to_e164(c, "DE")) == [wanted]


def test_phone_of_other_regions(spark):
    assert column(spark, ["(212) 555-0100"], lambda c: to_e164(c, "US")) == ["+12125550100"]
    assert column(spark, ["1 212 555 0100"], lambda c: to_e164(c, "US")) == ["+12125550100"]
    assert column(spark, ["06 1234 5678"], lambda c: to_e164(c, "IT")) == ["+390612345678"]
    with pytest.raises(ValueError):
        to_e164(F.lit("1"), "XX")


def test_days_open(spark):
    cases = {
        None: 0, "": 0, "  ": 0, "null": 0, "12": 0, '"mon"': 0, "true": 0,
        '{"mon": "9-17", "tue": "", "wed": null, "thu": 0, "fri": 0.00, "sat": [], "sun": "0"}': 2,
        '{"a": {}, "b": false, "c": true, "d": -0.0, "e": 0e5, "f": [0], "g": 1e-9}': 3,
        '{"mon": "9", "mon": ""}': 0,
        '["mon", "", null]': 3, "[]": 0, "{}": 0, " [1] ": 1,
        "Mon-Fri 9-17, mon": 2, "monthly": 1, "9-17 mon": 1, '["mon"] and tue': 2,
        "{'mon': '9'}": 1, '"mon" tue': 2, "{mon": 1, "open daily": 0, "[1] [2]": 0, "1} mon": 1,
    }
    got = column(spark, list(cases), days_open)
    assert dict(zip(cases, got)) == cases


def test_booleans(spark):
    values = ["true", " YES ", "1", "y", "false", "0", "No", "n", "", None, "maybe", "0.0"]
    got = column(spark, values, lambda c: to_boolean(c, T.StringType()))
    assert got == [True] * 4 + [False] * 6 + [True] * 2


def test_numbers(spark):
    values = ["1", " 2.5 ", "1e3", "-.5", "1.5d", "12,5", "nan", "", None, "x", "inf", "0x1f"]
    got = column(spark, values, lambda c: to_number(c, T.StringType()))
    assert got == [1.0, 2.5, 1000.0, -0.5, None, None, None, None, None, None, float("inf"), None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "score double")
    assert [r.score for r in coerce_types(df).collect()] == [None, 2.0]


def test_times(spark):
    values = ["2026-01-02", "2026-01-02T03:04:05", "01.03.2026", "soon", None]
    got = column(
        spark, values,
        lambda c: F.date_format(to_time(c, T.StringType(), ("dd.MM.yyyy",)), "yyyy-MM-dd HH:mm:ss"),
    )
    assert got == ["2026-01-02 00:00:00", "2026-01-02 03:04:05", "2026-03-01 00:00:00", None, None]


def test_headers(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["STREET ADDRESS", "HAS", " My-Own Field "])
    assert rename_columns(df).columns == ["street_address", "has_flag_raw", "my_own_field"]
    clash = spark.createDataFrame([("a", "b")], ["X Y", "X-Y"])
    with pytest.raises(ValueError):
        rename_columns(clash)
