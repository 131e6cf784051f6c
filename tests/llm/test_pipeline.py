import corpus_pipeline
import pytest
from conftest import SF_DIR
from odd import frame, no_docs, odd_docs, prose
from test_containment import contained
from test_packing import check
from test_simhash import components, slow_fingerprint
from test_substrings import kept_words

from stammwerk.llm.shared import stored


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage on the driver's smallest tables."""
    docs, seen = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF_DIR), name)
        seen[name] = (docs, after)
        docs = after
    return seen


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_are_kept(spark, stages):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    for name, (_, after) in list(stages.items())[:-1]:
        assert [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in schema], name


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    known = [(r.doc_id in kept) == (labels[r.doc_id] == 0) for r in before.collect() if r.doc_id in labels]
    assert sum(known) / len(known) > 0.95


def test_one_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near_dedup"])
    ids = [d for d, _ in before]
    least = components([slow_fingerprint(t) for _, t in before], ids)
    assert sorted(d for d, _ in after) == sorted(set(least))


def test_repeated_passages_go(stages):
    before, after = (x for x in stages["substring_dedup"])
    rows = texts(before)
    want = {d: t if len(k) == n else b" ".join(k).decode() for (d, t), (n, k) in zip(rows, kept_words(rows))}
    assert dict(texts(after)) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_leaks_go(spark, stages):
    before, after = (texts(x) for x in stages["decontamination"])
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {d for _, d, *_ in contained(before, bench)}
    assert bad and sorted(d for d, _ in after) == sorted(d for d, _ in before if d not in bad)


def test_the_rest_is_packed(spark, stages):
    before, after = stages["packing"]
    check(after.toPandas(), texts(before))
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.count() == after.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, name, stage):
    for docs in (odd_docs(spark), no_docs(spark)):
        after = stage(spark, docs, SF_DIR)
        if name != "packing":
            assert after.columns == docs.columns
        assert (after.count() > 0) == (docs.count() > 0)


def test_clean_documents_pass_untouched(spark):
    # Ids that no label speaks of.
    rows = [(10**6 + d, prose(f"clean {d}", 80 + d)) for d in range(30)]
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
    assert dict(texts(docs)) == dict(rows)
