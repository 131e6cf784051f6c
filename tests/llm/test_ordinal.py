import numpy as np
import pytest
from conftest import SF_DIR
from odd import ODD_ROWS, frame, no_docs, odd_docs, prose

from stammwerk.llm.ordinal import fit, train
from stammwerk.llm.quality import graded, rated_quality
from stammwerk.llm.toxicity import drop_toxic, severities

RUDE = "grumbold snarfing wretchly"


def graded_docs(spark, n=240):
    """Texts of three severities: no rude word, one in forty words, one in ten."""
    docs, labels = [], []
    for d in range(n):
        grade = d % 3
        words = prose(f"g{d}", 120).split()
        for k in range(0, 120, {0: 1000, 1: 40, 2: 10}[grade]):
            words[k] = RUDE.split()[(d + k) % 3] if grade else words[k]
        docs.append((d, " ".join(words)))
        labels.append((d, grade, "z"))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int, score string")


def test_three_grades_on_held_out_documents(spark):
    docs, labels = graded_docs(spark)
    model = train(docs, labels.where("doc_id < 150"), "toxic")
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    found = severities(docs, model=model).toPandas()
    held = found[found.doc_id >= 150]
    grade = held.doc_id % 3
    assert (held.rejected == (grade > 0)).mean() > 0.95
    means = held.groupby(grade).expected_severity.mean()
    assert means[0] < 0.4 < means[1] < 1.6 < means[2]
    assert ((found.p_toxic >= 0) & (found.p_toxic <= 1)).all()


def test_the_sample_is_bounded(spark):
    docs, labels = graded_docs(spark, 60)
    small = train(docs, labels, "toxic", sample_rows=5)
    assert small.grades and set(small.grades) <= {0, 1, 2}


def test_odd_documents(spark):
    docs, labels = graded_docs(spark)
    model = train(docs, labels, "toxic")
    found = severities(odd_docs(spark), model=model).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in ODD_ROWS)
    assert not any(r.rejected for r in found)
    rude = frame(spark, [(1, RUDE * 3), (None, RUDE * 3), (2, None), (2, RUDE * 3), (3, "")])
    kept = drop_toxic(rude, labels)
    assert kept.schema == rude.schema
    assert severities(no_docs(spark), model=model).count() == 0


def test_without_labels_nothing_is_rejected(spark):
    docs, labels = graded_docs(spark, 12)
    none = labels.where("false")
    assert severities(docs, none).where("rejected").count() == 0
    assert drop_toxic(docs, none).count() == 12
    nulls = labels.selectExpr("CAST(NULL AS long) AS doc_id", "toxic").union(
        labels.selectExpr("doc_id", "CAST(NULL AS int) AS toxic"))
    assert severities(docs, nulls).where("rejected").count() == 0
    one = labels.selectExpr("doc_id", "1 AS toxic")
    assert {r.expected_severity for r in severities(docs, one).collect()} == {1.0}
    assert severities(no_docs(spark), none).count() == 0


def test_grades_from_labels(spark):
    labels = spark.createDataFrame(
        [(1, 0, 0), (2, 0, 1), (3, 1, 1), (4, 1, 0), (5, 1, None), (6, None, 1)],
        "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in graded(labels).collect()} == {1: 0, 2: 0, 3: 1, 4: 2, 5: 2, 6: None}


def test_quality_without_ratings(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, grade int")
    found = rated_quality(docs, none)
    assert found.count() == len(ODD_ROWS) and found.where("selected").count() == 0
    all_good = docs.selectExpr("doc_id", "2 AS grade")
    assert rated_quality(docs, all_good).where("NOT selected").count() == 0
    assert rated_quality(no_docs(spark), none).count() == 0


def test_gradient_finds_the_best_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    latent = 2 * x + rng.logistic(size=300)
    grade = np.digitize(latent, [-1.0, 1.0])
    model = fit(grade, np.arange(300), np.where(x > 0, 3, 5), np.abs(x), bits=4, iterations=400, penalty=0.0)
    assert model.weights[3] > 0 > model.weights[5]
    assert model.thresholds[0] < model.thresholds[1]
    assert set(np.flatnonzero(model.weights)) == {3, 5}


@pytest.mark.parametrize("name", ["op9_toxicity", "op5_quality_classifier"])
def test_whole_table_against_labels(spark, name):
    from stammwerk.llm.queries import queries

    found = queries()[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found.count() == documents.count()
    both = found.join(labels, "doc_id").toPandas()
    right = both.rejected == (both.toxic == 1) if name == "op9_toxicity" else both.selected == (both.quality == 1)
    assert right.mean() > 0.9
