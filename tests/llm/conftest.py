import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """rows of (doc_id, text[, lang]) -> (DataFrame, folder with documents.parquet)"""
    def make(rows, **tables):
        folder = str(tmp_path_factory.mktemp("docs"))
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
        return spark.read.parquet(f"{folder}/documents.parquet"), folder
    return make
