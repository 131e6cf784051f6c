"""Quality classifier: ordinal regression on graded ratings of documents.

A document's grade is 0 where it is rated as poor, 1 where it is well made but toxic, and
2 where nothing speaks against it. The model's expected grade ranks documents; its tail
probability P(grade >= 1), that a document is no junk, selects them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.ordinal import SAMPLE_ROWS, OrdinalModel, score, train

LEAST_GRADE = 1
LEAST_PROBABILITY = 0.5


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from 0/1 labels; a null ``toxic`` counts as not toxic."""
    good = F.col("quality").cast("int")
    clean = F.lit(1) - F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    return labels.select("doc_id", F.when(good == 0, 0).when(good == 1, 1 + clean).alias("grade"))


def rated_quality(
    docs: DataFrame,
    ratings: DataFrame | None = None,
    model: OrdinalModel | None = None,
    least_grade: int = LEAST_GRADE,
    least_probability: float = LEAST_PROBABILITY,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Expected grade and selection of every row.

    ``ratings`` holds (doc_id, grade); a model fitted before may be given instead.
    Returns (doc_id, text_key, score, expected_grade, tail_probability, selected), the tail
    being P(grade >= ``least_grade``). A null or empty text has no features and gets what the
    thresholds say. Without ratings all documents get grade 0, or the one grade there
    is, and are selected if that is high enough. Repeated rows and rows without an id are scored
    like others; other columns play no part; an empty table gives an empty result.
    """
    if model is None:
        model = train(docs, ratings, "grade", id_column, text_column, sample_rows)
    above = [k for k, grade in enumerate(model.grades[1:]) if grade >= least_grade]
    if model.grades[0] >= least_grade:
        tail = F.lit(1.0)
    else:
        tail = F.col("tails")[above[0]] if above else F.lit(0.0)
    return score(docs, model, id_column, text_column).select(
        "doc_id", "text_key", "score", F.col("expected").alias("expected_grade"),
        tail.alias("tail_probability"), (tail >= least_probability).alias("selected"),
    )
