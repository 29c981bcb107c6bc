import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text[, source]) rows, over a few partitions."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def saved(tmp_path_factory):
    """A folder with the frames as the tables that the queries read."""
    def save(**tables):
        path = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return str(path)
    return save
