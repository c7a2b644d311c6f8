import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark, tmp_path):
    """A documents table in files, as the operators read it: (doc_id, text[, source]) rows."""
    made = [0]

    def make(rows, extra=(), files=2):
        made[0] += 1
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.withColumn(name, F.lit("other"))
        path = str(tmp_path / f"docs{made[0]}")
        df.repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return make
