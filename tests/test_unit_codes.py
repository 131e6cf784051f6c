import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stammwerk.functions.unit_codes import FEED_LAYOUT, FLATTEN_LAYOUT, decode_unit


def decoded(spark, value, kind="bigint", **options):
    df = spark.createDataFrame([(value,)], f"code {kind}")
    return df.select(*[c.alias(p) for p, c in decode_unit(F.col("code"), **options).items()]).first().asDict()


@pytest.mark.parametrize(
    "code, expected",
    [
        (203040050069, (20, 30, 400, 500)),
        (0, (0, 0, 0, 0)),
        (9123456789012, (12, 34, 567, 890)),
        (91234567890123, (12, 34, 567, 890)),  # a 14th digit is cut off
        (None, (None, None, None, None)),
    ],
)
def test_feed_layout(spark, code, expected):
    found = decoded(spark, code, layout=FEED_LAYOUT)
    assert tuple(found[p] for p in ("area", "manager", "branch", "department")) == expected


def test_flatten_layout(spark):
    found = decoded(spark, 9123456789012, layout=FLATTEN_LAYOUT)
    assert found == {"branch": 12, "manager": 34, "department": 567, "area": 890}


def test_letters_raise_or_become_null(spark):
    assert decoded(spark, "0AB3456789012", "string", strict=False) == {
        "area": None, "manager": 34, "branch": 567, "department": 890}
    with pytest.raises(PySparkException):
        decoded(spark, "0AB3456789012", "string")
