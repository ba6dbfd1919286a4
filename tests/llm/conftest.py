import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    """The folder a cluster would name in spark.checkpoint.dir."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """Documents with nulls, repeats, a clash of names and very different lengths."""

    def make(rows):
        columns = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n int, spans int"
        full = [(i, t, "en", s, len(t or ""), 0.0, "k", 1, 2) for i, t, s in rows]
        return spark.createDataFrame(full, columns).repartition(3)

    return make
