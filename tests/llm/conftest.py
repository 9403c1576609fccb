import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from llm_helpers import CLASHING, EDGE_ROWS, SF, frame  # noqa: E402

from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("local[*]", app="tessera-tests", shuffle_partitions=8)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    from pyspark.sql import functions as F
    df = frame(spark, EDGE_ROWS)
    return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                     F.lit(1).cast("bigint").alias("n_chars"), *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
