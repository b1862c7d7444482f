from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string, kind string"


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names clash with inner ones."""

    def make(texts, first=0):
        rows = [(first + i, t, "en", "s", None if t is None else len(t), "x", "y", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def sf_dir(tmp_path, spark):
    """Writes tables as the driver lays them out."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
