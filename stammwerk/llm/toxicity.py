"""Toxicity: ordinal regression of severity grades on sparse text features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.ordinal import SAMPLE_ROWS, OrdinalModel, score, train
from stammwerk.llm.shared import text_key

# P(severity >= 1) from which a document is rejected.
REJECT_PROBABILITY = 0.5


def severities(
    docs: DataFrame,
    labels: DataFrame | None = None,
    model: OrdinalModel | None = None,
    severity_column: str = "toxic",
    reject_probability: float = REJECT_PROBABILITY,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Expected severity of every row's whole text.

    ``labels`` holds (doc_id, severity grades 0, 1, ...); a model fitted before may be
    given instead. Returns (doc_id, text_key, score, expected_severity, p_toxic, rejected).
    A null or empty text has no features and is not rejected. Without labels, or with
    one grade only, every text has that grade (or 0). Repeated rows and rows without an
    id are scored like others; other columns play no part; an empty table gives an
    empty result.
    """
    if model is None:
        model = train(docs, labels, severity_column, id_column, text_column, sample_rows)
    above = [k for k, grade in enumerate(model.grades[1:]) if grade >= 1]
    tail = F.col("tails")[above[0]] if above else F.lit(float(model.grades[0] >= 1))
    wordless = F.col("score") == 0
    return score(docs, model, id_column, text_column).select(
        "doc_id", "text_key", "score", F.col("expected").alias("expected_severity"),
        tail.alias("p_toxic"),
        ((tail >= reject_probability) & ~wordless).alias("rejected"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
               text_column: str = "text", **options) -> DataFrame:
    """The documents that are not rejected; columns as in ``docs``."""
    found = severities(docs, labels, id_column=id_column, text_column=text_column, **options)
    bad = found.where("rejected").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text")
    ).distinct()
    on = F.col(id_column).cast("long").eqNullSafe(F.col("_bad_id")) & (
        text_key(text_column) == F.col("_bad_text")
    )
    return docs.join(bad, on, "left_anti")
