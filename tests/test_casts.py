import math
from datetime import datetime

import pytest

from pyspark.sql import functions as F, types as T

from tablekit.functions import cast_is_defined, tolerant_cast

INTEGERS = [
    ("2006", 2006),
    (" 2006 ", 2006),
    ("+7", 7),
    ("-7", -7),
    ("2006.0", 2006),
    ("2006.7", 2006),
    ("-2006.7", -2006),
    ("5.", 5),
    (".", None),
    (".5", None),
    ("2e3", None),
    ("", None),
    ("2,006", None),
    ("n/a", None),
    ("1.2.3", None),
    ("2147483647", 2147483647),
    ("99999999999", None),
    (None, None),
]
DOUBLES = [
    ("4.99", 4.99),
    (".5", 0.5),
    ("1d", 1.0),
    ("1f", 1.0),
    ("2e3", 2000.0),
    ("inf", math.inf),
    ("4,99", None),
    ("$4.99", None),
    ("", None),
    (None, None),
]
TIMESTAMPS = [
    ("2006-02-15 04:34:33", datetime(2006, 2, 15, 4, 34, 33)),
    ("2006-02-15T04:34:33Z", datetime(2006, 2, 15, 4, 34, 33)),
    ("2006-02-15", datetime(2006, 2, 15)),
    ("2006-02", datetime(2006, 2, 1)),
    ("2006", datetime(2006, 1, 1)),
    ("02/15/2006", None),
    ("2006-13-45", None),
    ("0", None),
    ("38763.19", None),
    ("", None),
    (None, None),
]


def cast_all(spark, values, source, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {source}")
    kind = T._parse_datatype_string(target)
    cast = df.select("i", tolerant_cast(F.col("v"), df.schema["v"].dataType, kind).alias("c"))
    if target == "timestamp":
        cast = cast.withColumn("c", F.col("c").cast("timestamp_ntz"))
    return [row["c"] for row in cast.orderBy("i").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "target, cases", [("int", INTEGERS), ("double", DOUBLES), ("timestamp", TIMESTAMPS)]
)
def test_text_casts(spark, conf, ansi, target, cases):
    conf("spark.sql.ansi.enabled", ansi)
    texts, expected = zip(*cases)
    assert cast_all(spark, texts, "string", target) == list(expected)


def test_not_a_number_text_is_a_double(spark):
    assert math.isnan(cast_all(spark, ["NaN"], "string", "double")[0])


@pytest.mark.parametrize(
    "source, values, target, expected",
    [
        ("double", [2006.7, 3e9, math.nan], "int", [2006, None, None]),
        ("bigint", [5, 2**40], "int", [5, None]),
        ("int", [5], "double", [5.0]),
        ("bigint", [86400], "timestamp", [datetime(1970, 1, 2)]),
        ("double", [0.5], "timestamp", [datetime(1970, 1, 1, 0, 0, 0, 500000)]),
    ],
)
def test_typed_casts(spark, source, values, target, expected):
    assert cast_all(spark, values, source, target) == expected


def test_a_cast_spark_lacks_is_reported(spark):
    df = spark.createDataFrame([(True, "x")], "flag boolean, text string")
    assert not cast_is_defined(df, "flag", T.TimestampType())
    assert cast_is_defined(df, "text", T.TimestampType())
