"""Column functions on literal inputs with known answers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import arrays as A
from riskframe.functions import bins as B
from riskframe.functions import numbers as M
from riskframe.functions import recode as R
from riskframe.functions import temporal as D
from riskframe.functions import text as T


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, col):
    return one.select(col.alias("v")).first()["v"]


def values(spark, rows, schema, fn):
    """Apply a Column function of column x to the rows, in order."""
    data = [(i, r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"i int, x {schema}")
    return [r["v"] for r in df.select("i", fn(F.col("x")).alias("v")).orderBy("i").collect()]


def test_floor_division_and_modulo(spark):
    assert values(spark, [7, -7], "int", lambda x: M.floor_div(x, F.lit(2))) == [3, -4]
    assert values(spark, [7, -7], "int", lambda x: M.floor_mod(x, F.lit(3))) == [1, 2]


def test_safe_ratios(one):
    lit = lambda x: F.lit(x).cast("double")
    assert value(one, M.ratio(lit(1), lit(0))) is None
    assert value(one, M.ratio_or(lit(1), lit(0))) == 0.0
    assert value(one, M.ratio_or_inf(lit(10), lit(0))) == math.inf
    assert value(one, M.ratio_or_inf(lit(0), lit(0))) == 0.0
    assert value(one, M.ratio_or_inf(lit(10), lit(2))) == 5.0


def test_half_even_rounding(spark):
    assert values(spark, [2.5, 3.5, 150.0, 250.0], "double", M.round_half_even) == [2, 4, 150, 250]
    assert values(spark, [150.0, 250.0, 12345.0], "double", lambda x: M.round_half_even(x, -2)) == [200, 200, 12300]


def test_clip(spark):
    got = values(spark, [-10.0, 250.0, 720.0, 900.0, 500.0, None], "double", lambda x: M.clip(x, 300.0, 850.0))
    assert got == [300, 300, 720, 850, 500, None]


def test_nan_to_num(spark):
    got = values(spark, [1.0, math.nan, 3.0, math.inf, -math.inf], "double", M.nan_to_num)
    assert got == [1, 0, 3, 1e6, -1e6]


def test_narrow_int(spark):
    assert values(spark, [5, 3_000_000_000], "long", M.narrow_int) == [5, None]


def test_close_to(one):
    assert value(one, M.close_to(F.lit(0.1 + 0.2), F.lit(0.3)))
    assert not value(one, M.close_to(F.lit(0.31), F.lit(0.3)))


def test_flags_treat_missing_as_false(spark):
    assert values(spark, [500.0, 700.0, None], "double", lambda x: R.flag(x < 600)) == [1, 0, 0]


def test_first_match_order(spark):
    rules = lambda x: R.first_match([(x > 8, "Block"), (x > 5, "Review")], "Allow")
    assert values(spark, [9.0, 6.0, 1.0, None], "double", rules) == ["Block", "Review", "Allow", "Allow"]


def test_rule_list(spark):
    rules = lambda x: R.first_rule([F.when(x < 0, "Has prior defaults"), F.when(x < 650, "Score too low")], "Approved")
    assert values(spark, [600, 700, -1], "int", rules) == ["Score too low", "Approved", "Has prior defaults"]


def test_recodes(spark):
    table = {"Rent": 0, "Own": 2}
    assert values(spark, ["Rent", "Other", None], "string", lambda x: R.lookup(x, table)) == [0, None, None]
    assert values(spark, ["Rent", "Other", None], "string", lambda x: R.lookup_or(x, table, -1)) == [0, -1, -1]
    assert values(spark, ["A", "B"], "string", lambda x: R.replace_values(x, {"A": "Z"})) == ["Z", "B"]
    assert values(spark, ["", "  ", None, "x"], "string", lambda x: R.text_or(x, "N/A")) == ["N/A", "N/A", "N/A", "x"]


def test_bin_edges(spark):
    edges = [300, 600, 700, 850]
    labels = ["High", "Medium", "Low"]
    cut = lambda x: B.cut(x, edges, labels)
    # (low, high]: the lowest edge and everything outside is null
    assert values(spark, [300.0, 301.0, 600.0, 601.0, 850.0, 851.0], "double", cut) == [None, "High", "High", "Medium", "Low", None]
    assert values(spark, [21, 30, 29, 75], "int", lambda x: B.digitize(x, [21, 30, 40, 50, 60, 75])) == [1, 2, 1, 6]
    assert values(spark, [600, 601, None], "int", lambda x: B.search_sorted(x, [600, 700])) == [0, 1, None]
    last = lambda x: B.equal_width(x, F.lit(0.0), F.lit(1.0), 3)
    assert values(spark, [0.0, 1.0, 2.5, 3.0, 3.1], "double", last) == [0, 1, 2, 2, None]


def test_text_helpers(spark):
    card = "7300158826049137"
    assert values(spark, [card], "string", T.mask_keep_last) == ["*" * 12 + "9137"]
    assert values(spark, ["  alice SMITH "], "string", T.clean_name) == ["Alice Smith"]
    assert values(spark, ["ABCDEF"], "string", T.every_nth_char) == ["ACE"]
    assert values(spark, ["banana", "xyz"], "string", lambda x: T.index_of(x, "an")) == [1, -1]
    assert values(spark, ["banana"], "string", lambda x: T.count_of(x, "an")) == [2]
    assert values(spark, ["123", "12a", ""], "string", T.is_digits) == [True, False, False]
    assert values(spark, ["a,,b"], "string", lambda x: T.split_nonempty(x, ",")) == [["a", "b"]]
    assert values(spark, ["riskscore", "level", "ab"], "string", T.can_be_palindrome) == [False, True, False]
    assert values(spark, [15234.5], "double", T.money) == ["$15,234.50"]
    assert values(spark, [5.75], "double", T.percent) == ["5.75%"]
    assert values(spark, [1234567], "long", T.thousands) == ["1,234,567"]


def test_key_value_text(spark):
    got = values(spark, ["score: 720 | balance: 15000 | region: West"], "string", T.key_values)[0]
    assert got == {"score": "720", "balance": "15000", "region": "West"}
    ints = values(spark, ["a:1|b:x"], "string", lambda x: T.int_values(T.key_values(x)))[0]
    assert ints == {"a": 1, "b": None}


def test_pairs_to_map(spark):
    got = values(spark, ["score=720;balance=15000;age=5;age=6"], "string", lambda x: T.pairs_to_map(x, r"(\w+)=(\d+)"))[0]
    assert got == {"score": "720", "balance": "15000", "age": "6"}


def test_entities(spark):
    notes = [
        "Ring back on 613-880-2290 about the refund of $7,214.05",
        "Wants letters at m.okoro@post.example only",
        "Moved to AC4412 last week; reach at 208.331.7745",
    ]
    pick = lambda name: values(spark, notes, "string", lambda x: T.entities(x)[name])
    assert pick("phone") == ["613-880-2290", None, "208.331.7745"]
    assert pick("amount") == ["$7,214.05", None, None]
    assert pick("email") == [None, "m.okoro@post.example", None]
    assert pick("account") == [None, None, "AC4412"]


def test_regex_anchors(spark):
    assert values(spark, ["31 days late", "Late by 31 days"], "string", lambda x: T.starts_with_pattern(x, r"\d+")) == [True, False]
    assert values(spark, ["Lots 7, 4410 and 903218"], "string", lambda x: T.find_all(x, r"\d{3,5}")) == [["4410", "90321"]]
    emails = ["t.iyer@loans.example", "loans.example", "desk.two@office.net"]
    assert values(spark, emails, "string", lambda x: x.rlike(T.VALID_EMAIL)) == [True, False, True]


def test_mixed_dates(spark):
    got = values(spark, ["03/15/2024", "07-01-2024", "2024-01-05", "not a date"], "string", D.parse_mixed)
    assert got == [dt.date(2024, 3, 15), dt.date(2024, 7, 1), dt.date(2024, 1, 5), None]


def test_days_late(spark):
    rows = [("2024-01-05", "2024-01-04"), ("2024-01-05", "2024-01-20"), ("2024-01-05", "2024-02-15")]
    df = spark.createDataFrame(rows, "due string, paid string")
    late = D.days_late(D.parse_date("paid"), D.parse_date("due"))
    got = [r[0] for r in df.select(late).collect()]
    assert got == [0, 15, 41]
    assert values(spark, got, "int", D.delay_status) == ["On Time", "Minor Delay", "Severely Delinquent"]
    assert values(spark, got, "int", D.payment_status) == ["On Time", "Late", "Severely Delinquent"]


def test_ages_need_a_reference_date(one):
    start = F.lit("2023-06-01").cast("date")
    assert value(one, D.age_months(dt.date(2024, 3, 15), start)) == 9
    assert value(one, D.age_years(dt.date(2024, 6, 1), start)) == 1.0
    assert value(one, D.long_date(F.lit("2024-03-15").cast("date"))) == "March 15, 2024"


def test_vectors(one):
    a, b = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(4.0), F.lit(6.0))
    assert value(one, A.dot(a, b)) == 16
    assert value(one, A.distance(a, b)) == 5
    assert value(one, A.value_range(b)) == 2
    assert value(one, A.linspace(0, 1, 5)) == [0, 0.25, 0.5, 0.75, 1]
    assert value(one, A.arange(0, 10, 3)) == [0, 3, 6, 9]
    assert value(one, A.mean(F.array().cast("array<double>"))) is None


def test_maps(one):
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    other = F.create_map(F.lit("b"), F.lit(9), F.lit("c"), F.lit(3))
    assert value(one, A.merge_maps(m, other)) == {"a": 1, "b": 9, "c": 3}
    assert value(one, A.drop_key(m, "a")) == {"b": 2}
    assert value(one, A.invert_map(m)) == {1: "a", 2: "b"}
    assert value(one, A.map_get(m, "z", 0)) == 0
    matrix = F.array(F.array(F.lit(1), F.lit(6)), F.array(F.lit(7), F.lit(2)))
    assert value(one, A.matrix_map(matrix, lambda v: F.when(v > 5, "High").otherwise("Low"))) == [["Low", "High"], ["High", "Low"]]
