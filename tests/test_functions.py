from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.functions.dates import load_day, parse_date, parse_timestamp
from touchline.functions.keys import digest_id
from touchline.functions.minutes import minute_bucket, parse_minute
from touchline.functions.numbers import (
    as_int,
    decimal_text,
    decimal_text_to_int,
    digits_to_int,
    percent_text,
    ratio,
)
from touchline.functions.outcomes import (
    RESULT_POINTS,
    by_side,
    flag,
    is_home_side,
    known_result,
    lookup,
    result_or_draw,
)
from touchline.functions.text import clean_text
from touchline.plans.layouts import CARD_WEIGHTS, card_label

NBSP = "\u00a0"


def apply(spark, schema, rows, *columns):
    """Evaluate columns over rows, in order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "i int, " + schema).orderBy("i")
    return [tuple(row) if len(columns) > 1 else row[0] for row in frame.select(*columns).collect()]


def one(spark, inputs, function, kind="string"):
    return apply(spark, f"x {kind}", [(value,) for value in inputs], function(F.col("x")))


def test_clean_text(spark):
    inputs = [" x ", "", " ", NBSP + "x ", NBSP, None, "a" + NBSP + "b"]
    assert one(spark, inputs, clean_text) == ["x", None, None, "x", None, None, "a b"]


def test_parse_minute(spark):
    inputs = ["45+2", " 90", "abc", None, "45+", "45 +2", "", "99999999999", "7+99999999999"]
    parsed = apply(spark, "x string", [(v,) for v in inputs], *parse_minute(F.col("x"))[1:])
    assert parsed == [
        (45, 2, 47), (90, 0, 90), (None, 0, None), (None, None, None), (45, 0, 45), (45, 0, 45),
        (None, 0, None), (None, 0, None), (7, None, None),
    ]
    assert one(spark, [" 45+2 "], lambda c: parse_minute(c).raw) == ["45+2"]


def test_numbers(spark):
    texts = ["1.234,5%", "-", "12", "10.5", "-3", "1-2", "", None]
    assert one(spark, texts, digits_to_int) == [12345, None, 12, 105, -3, None, None, None]
    assert one(spark, texts, decimal_text) == [None, None, 12.0, 10.5, -3.0, None, None, None]
    assert one(spark, ["55%", "45,5%", ""], percent_text) == [55.0, 45.5, None]
    assert one(spark, ["12", "7,9", "-7.9", "x", "1e30"], decimal_text_to_int) == [12, 7, -7, None, 130]
    assert one(spark, ["99999999999"], decimal_text_to_int) == [None]
    assert one(spark, ["12", " 7 ", "x", "", None], as_int) == [12, 7, None, None, None]


def test_minute_bucket(spark):
    minutes = [None, -1, 0, 15, 16, 30, 31, 45, 46, 47, 60, 61, 75, 76, 90, 91, 130]
    assert one(spark, minutes, minute_bucket, "int") == [
        None, "00_15", "00_15", "00_15", "16_30", "16_30", "31_45", "31_45", "46_60", "46_60", "46_60", "61_75",
        "61_75", "76_90", "76_90", "90_plus", "90_plus",
    ]


def test_card_labels_and_weights(spark):
    inputs = [" Amarelo", "RED", "azul", "", None, "vermelho", "Yellow"]
    labels = one(spark, inputs, card_label)
    assert labels == ["yellow", "red", "azul", "", None, "red", "yellow"]
    weights = one(spark, labels, lambda c: lookup(c, CARD_WEIGHTS))
    assert weights == [1, 2, None, None, None, 2, 1]


def test_dates(spark):
    inputs = ["29/03/2003", "2003-03-29", "bad", "31/02/2003", "2003-3-9", "29-03-2003", "", None]
    day = date(2003, 3, 29)
    assert one(spark, inputs, parse_date) == [day, day, None, None, None, None, None, None]
    assert one(spark, ["2024-01-02", "", "x"], load_day) == [date(2024, 1, 2), None, None]


def test_timestamps(spark):
    rows = [
        ("29/03/2003", "16:00"), ("2003-03-29", "16:00"), ("29/03/2003", "16:00:30"), ("2003-03-29", "16:00:30"),
        ("bad", "x"), ("29/03/2003", None), (None, "16:00"), ("29/03/2003", "25:00"), ("29/03/2003", "9:00"),
    ]
    full, seconds = datetime(2003, 3, 29, 16), datetime(2003, 3, 29, 16, 0, 30)
    found = apply(spark, "d string, t string", rows, parse_timestamp(F.col("d"), F.col("t")).cast("timestamp_ntz"))
    assert found == [full, full, seconds, seconds, None, None, None, None, None]


def test_routed_parsing_equals_trying_every_form(spark):
    inputs = ["29/03/2003", "2003-03-29", "x", "1/1/2003", "03/29/2003", "2003/03/29", "29-03-2003", "12003-01-01"]
    tried = F.coalesce(F.try_to_date("x", "dd/MM/yyyy"), F.try_to_date("x", "yyyy-MM-dd"))
    assert one(spark, inputs, parse_date) == one(spark, inputs, lambda c: tried)


def test_results(spark):
    rows = [(2, 0), (0, 2), (1, 1), (1, None), (None, None)]
    found = apply(
        spark, "a int, b int", rows,
        result_or_draw(F.col("a"), F.col("b")), known_result(F.col("a"), F.col("b")),
    )
    assert found == [("win", "win"), ("loss", "loss"), ("draw", "draw"), ("draw", None), ("draw", None)]
    points = one(spark, ["win", "draw", "loss", "x", None], lambda c: lookup(c, RESULT_POINTS))
    assert points == [3, 1, 0, None, None]


def test_unknown_scores_earn_a_draw_point_but_no_draw_flag(spark):
    result = result_or_draw(F.col("a"), F.col("b"))
    found = apply(
        spark, "a int, b int", [(1, None)], lookup(result, RESULT_POINTS), flag(F.col("a") == F.col("b"))
    )
    assert found == [(1, 0)]


def test_sides(spark):
    rows = [("A", "A", "B"), ("B", "A", "B"), ("C", "A", "B"), (None, "A", "B"), ("A", None, None)]
    home = is_home_side(F.col("t"), F.col("h"), F.col("a"))
    found = apply(spark, "t string, h string, a string", rows, home, by_side(home, F.col("a"), F.col("h")))
    assert found == [(True, "B"), (False, "A"), (None, None), (None, None), (None, None)]


def test_ratio(spark):
    rows = [(4, None), (4, 0), (4, 10), (None, 10)]
    assert apply(spark, "a int, b int", rows, ratio(F.col("a"), F.col("b"))) == [None, None, 0.4, None]


def test_digest_id(spark):
    import hashlib

    rows = [(7, "A", None), (None, "A", "B")]
    found = apply(spark, "m bigint, a string, b string", rows, digest_id(F.col("m"), F.col("a"), F.col("b")))
    assert found == [hashlib.sha256(text.encode()).hexdigest() for text in ("7||A||", "A||B")]


@pytest.mark.parametrize("value,expected", [(True, 1), (False, 0), (None, 0)])
def test_flag(spark, value, expected):
    assert one(spark, [value], flag, "boolean") == [expected]
