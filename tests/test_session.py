import pytest

from stammwerk.session import CHECKPOINT_SETTING, fresh_path, shared_folder


class FakeSession:
    """Only the configuration of a session."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get(CHECKPOINT_SETTING)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))


def test_a_local_folder_is_made_only_for_a_local_master():
    session = FakeSession(**{"spark.master": "local[8]"})
    assert shared_folder(session) == shared_folder(session)
    assert session.get(CHECKPOINT_SETTING) is None  # the caller's settings stay as they are
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession(**{"spark.master": "yarn"}))


def test_intermediate_data_is_removed_on_request(spark):
    from pyspark.errors import AnalysisException

    from stammwerk import session

    kept, session._made[:] = session._made[:], []  # other tests still read theirs
    try:
        path, df = session.stored_at(spark.range(5), "x")
        assert df.count() == 5
        assert session.clean_up(spark) == 1 and session.clean_up(spark) == 0
        with pytest.raises(AnalysisException):
            spark.read.parquet(path)
    finally:
        session._made[:] = kept
