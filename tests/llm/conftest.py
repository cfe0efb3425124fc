import uuid

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def written(spark, tmp_path):
    """A frame that is read from Parquet files, as the operators get theirs."""

    def write(rows, schema, files=2):
        path = f"{tmp_path}/{uuid.uuid4().hex}"
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture
def documents(written):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(*rows, files=2):
        filled = [(*r, *(None, None)[: 4 - len(r)]) for r in rows]
        return written([(i, t, lang, source, len(t) if t else None) for i, t, lang, source in filled], DOC_SCHEMA, files)

    return build
