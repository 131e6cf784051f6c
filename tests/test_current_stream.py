import pytest
from conftest import rows
from pyspark.sql import functions as F

from stammwerk.operators.versions import current_rows
from stammwerk.streaming import current_stream
from stammwerk.streaming.current_stream import CurrentStream, run_stream, stream_state, take_batch

SCHEMA = "k long, TSAEND timestamp, note string"


@pytest.fixture
def schema(spark, request):
    name = f"stream_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def versions(spark, found):
    return spark.createDataFrame(found, "k long, TSAEND long, note string").withColumn(
        "TSAEND", F.timestamp_seconds("TSAEND"))


def arrive(spark, folder, found):
    versions(spark, found).coalesce(1).write.mode("append").parquet(folder)


BATCHES = [
    [(k % 7, k, f"a{k}") for k in range(30)] + [(None, 3, "no key"), (2, None, "no time")],
    [(k % 9, 20 + k, f"b{k}") for k in range(20)],
    [(3, 1, "late"), (3, 500, "newest"), (100, 2, "new key, old"), (4, None, "no time")],
]


def stream_of(schema, **options):
    return CurrentStream(f"{schema}.current_x", ("k",), ("k",), ("note",), buckets=4, **options)


def test_batches_equal_one_run(spark, schema, tmp_path):
    folder, stream = str(tmp_path / "in"), stream_of(schema)
    for n, found in enumerate(BATCHES):
        arrive(spark, folder, found)
        state = run_stream(spark, stream, folder, SCHEMA, str(tmp_path / "checkpoint"), files_per_batch=1)
        assert state.batch == n
    everything = versions(spark, sum(BATCHES, []))
    assert rows(spark.table(stream.view)) == rows(current_rows(everything, ["k"], ["note"]))
    assert (state.rows, state.expired) == (56, 0)
    before = {r.k: r.TSAEND for r in current_rows(versions(spark, BATCHES[0]), ["k"], ["note"]).collect()}
    first_late = sum(r.k in before and r.TSAEND < before[r.k] for r in versions(spark, BATCHES[1]).collect())
    assert state.late == first_late + 1
    again = run_stream(spark, stream, folder, SCHEMA, str(tmp_path / "checkpoint"))
    assert again == state


def test_several_batches_in_one_run(spark, schema, tmp_path):
    folder, stream = str(tmp_path / "in"), stream_of(schema)
    for found in BATCHES:
        arrive(spark, folder, found)
    state = run_stream(spark, stream, folder, SCHEMA, str(tmp_path / "checkpoint"), files_per_batch=1)
    assert state.batch == 2 and state.rows == 56
    assert rows(spark.table(stream.view)) == rows(current_rows(versions(spark, sum(BATCHES, [])), ["k"], ["note"]))


def test_a_batch_that_comes_again_counts_once(spark, schema, monkeypatch):
    stream = stream_of(schema)
    take_batch(stream, versions(spark, BATCHES[0]), 0)

    def die(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(current_stream, "refresh_current", die)
        with pytest.raises(RuntimeError):
            take_batch(stream, versions(spark, BATCHES[1]), 1)
    assert stream_state(spark, stream.view).batch == 0
    take_batch(stream, versions(spark, BATCHES[1]), 1)
    once = stream_state(spark, stream.view)
    take_batch(stream, versions(spark, BATCHES[1]), 1)
    assert stream_state(spark, stream.view) == once and once.rows == 52


def test_versions_beyond_the_horizon_are_set_aside(spark, schema):
    stream = stream_of(schema, horizon="100 seconds")
    take_batch(stream, versions(spark, [(1, 1000, "a"), (2, 1, "old, but in the first batch")]), 0)
    take_batch(stream, versions(spark, [(1, 950, "late"), (3, 899, "gone"), (4, 900, "just in"), (5, None, "no time")]), 1)
    assert sorted((r.k, r.note) for r in spark.table(stream.view).collect()) == [
        (1, "a"), (2, "old, but in the first batch"), (4, "just in"), (5, "no time")]
    assert [(r.k, r._batch) for r in spark.table(stream.expired).collect()] == [(3, 1)]
    state = stream_state(spark, stream.view)
    assert (state.rows, state.late, state.expired) == (6, 1, 1)
    take_batch(stream, versions(spark, []), 2)
    assert stream_state(spark, stream.view).batch == 2
