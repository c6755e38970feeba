from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import ODD  # noqa: E402

#: Names the operators use inside; as columns of the input they must do no harm.
CLASHING = "key id th n i a b r k x h u v at node rep bits part kept rule ids size shard slot stratum seed item label path score html __th __gone __kept __leaked __deleted row doc pair".split()


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text, source) rows with columns of clashing names."""

    def docs(rows, partitions=3):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit("?") for c in CLASHING}).withColumn("n_chars", F.length("text").cast("long"))

    return docs


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])
