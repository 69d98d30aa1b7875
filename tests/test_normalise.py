import pytest
from pyspark.sql import functions as F

from indicator_lake.functions import measures, normalise


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_labels_lose_every_kind_of_white_space(spark):
    df = spark.createDataFrame([("\t Ano 1\n",), (" SIM　",), ("  ",), ("",), (None,), ("São ",)], "x string")
    assert one(df, normalise.lower_label(df, "x")) == ["ano 1", "sim", "", "", None, "são"]
    assert one(df, normalise.upper_label(df, "x"))[:2] == ["ANO 1", "SIM"]


def test_codes_are_padded_and_cut(spark):
    df = spark.createDataFrame([("123",), ("123456789",), (None,)], "x string")
    assert one(df, normalise.code(df, "x")) == ["0000123", "1234567", None]
    numbers = spark.createDataFrame([(2611606.0,), (12.0,)], "x double")
    assert one(numbers, normalise.code(numbers, "x")) == ["2611606", "0000012"]


def test_code_format_refuses_newline_and_other_digits(spark):
    df = spark.createDataFrame([("1234567",), ("1234567\n",), ("123456",), ("٢٦١١٦٠٦",), (None,)], "x string")
    assert one(df, normalise.is_code(F.col("x"))) == [True, False, False, False, None]


def test_safe_casts(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("1.5",), ("x",), ("99999999999999999999",), (None,)], "x string")
    assert one(df, normalise.safe_long(df, "x")) == [12, 12, None, None, None, None]
    assert one(df, normalise.safe_double(df, "x"))[:4] == [12.0, 12.0, 1.5, None]
    nan = spark.createDataFrame([("NaN",), ("2.5",)], "x string")
    assert one(nan, normalise.safe_double(nan, "x")) == [None, 2.5]
    halves = spark.createDataFrame([(1.5,), (2.5,), (-2.5,), (None,)], "x double")
    assert one(halves, normalise.safe_long(halves, "x")) == [2, 3, -3, None]


@pytest.mark.parametrize(
    "token, flag",
    [(t, True) for t in ("1", "sim", "s", "true")]
    + [(t, False) for t in ("0", "nao", "não", "n", "false")]
    + [("?", None), ("", None), (None, None)],
)
def test_tristate_flag(spark, token, flag):
    df = spark.createDataFrame([(token,)], "x string")
    assert one(df, normalise.tristate_flag(F.col("x"))) == [flag]


def test_status_with_and_without_guard(spark):
    rows = [(80.0, 80.0), (75.0, 80.0), (74.9, 80.0), (None, 80.0), (80.0, None)]
    df = spark.createDataFrame(rows, "rate double, target double")
    guarded = one(df, measures.target_status(F.col("rate"), F.col("target")))
    assert guarded == ["META_ATINGIDA", "PROXIMO_DA_META", "ABAIXO_DA_META", "SEM_COMPARACAO", "SEM_COMPARACAO"]
    plain = one(df, measures.target_status_unguarded(F.col("rate"), F.col("target")))
    assert plain[3:] == ["ABAIXO_DA_META", "ABAIXO_DA_META"]


def test_weighted_share_and_arg_max(spark):
    rows = [("a", True, 3.0, None), ("a", False, None, 5.0), ("a", None, 9.0, 7.0), ("b", None, 1.0, None)]
    df = spark.createDataFrame(rows, "k string, flag boolean, w double, rate double")
    got = df.groupBy("k").agg(
        measures.weighted_share(F.col("flag"), F.col("w")).alias("share"),
        measures.arg_max(F.col("w"), F.col("rate")).alias("best"),
    )
    assert {r.k: (r.share, r.best) for r in got.collect()} == {"a": (75.0, 9.0), "b": (None, 1.0)}


def test_safe_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a bigint, b bigint")
    assert one(df, measures.safe_percent(F.col("a"), F.col("b"))) == [None, 25.0]


def test_ends_of_texts_are_compared_as_bytes(spark):
    """Finding a text's first character as a number, or its last by counting, took most of the time of a label."""
    texts = ["a", " a ", "\ta　", "\x85b", "é", " é", "", " ", "~x~", "\x7fx\x7f", "a ", "１ ", "!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    trimmed = df.select(normalise.trim_ws(F.col("t")))
    assert [r[0] for r in trimmed.collect()] == [t.strip(normalise.WHITE_SPACE) for t in texts]
    assert "ascii(" not in trimmed._jdf.queryExecution().optimizedPlan().toString()


def test_integers_between_digits_are_cast_without_a_pattern(spark):
    texts = ["12", " 12 ", "+7", "1.5", "1e5", "0x10", "1 2", "7d", "12345678901234567890", "1١", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cast = df.select(normalise.safe_long(df, "t"))
    assert [r[0] for r in cast.collect()] == [12, 12, 7, *[None] * 9]
    assert " OR " in cast._jdf.queryExecution().optimizedPlan().toString()
