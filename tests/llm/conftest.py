import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None)
                for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


#: Columns whose names clash with helpers of the operators.
CLASHING = ["doc", "doc2", "bitmap", "lines", "stats", "rules", "hits", "chain", "fp", "id", "again", "n",
            "shard", "n_tokens", "n_bytes", "over_limit", "held_out", "lang_pred", "score", "got"]


def clash(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
