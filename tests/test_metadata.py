from datetime import date

import pytest
from pyspark.sql import functions as F

from stammwerk.functions.load_metadata import load_metadata, stamp


def test_default_columns(spark):
    found = stamp(spark.range(3), load_metadata("2024-06-30", "vault", "me"))
    assert dict(found.dtypes) == {
        "id": "bigint", "md_book_date": "date", "md_load_date": "timestamp",
        "md_load_user": "string", "md_source_system": "string"}
    rows = found.collect()
    assert {(r.md_book_date, r.md_load_user, r.md_source_system) for r in rows} == {
        (date(2024, 6, 30), "me", "vault")}
    assert len({r.md_load_date for r in rows}) == 1


def test_selected_columns(spark):
    metadata = load_metadata(date(2024, 6, 30), "v", "me", "delta", ["book_date", "md_load_type"])
    assert list(metadata) == ["md_book_date", "md_load_type"]
    assert stamp(spark.range(1), metadata).first().md_load_type == "delta"
    with pytest.raises(ValueError):
        load_metadata("2024-06-30", "v", "me", fields=["color"])


def test_plain_values_and_columns(spark):
    found = stamp(spark.range(2), {"a": "text", "b": F.col("id") + 1})
    assert [tuple(r) for r in found.orderBy("id").collect()] == [(0, "text", 1), (1, "text", 2)]
