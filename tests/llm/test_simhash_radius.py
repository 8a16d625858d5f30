"""A radius for which the buckets are not complete is refused."""

import pytest

from veritrail.llm import simhash


@pytest.mark.parametrize("radius", [3, -1])
def test_radius_beyond_the_buckets(spark, radius):
    nodes = spark.createDataFrame([(0,), (1 | 1 << 16 | 1 << 32,)], "fp long")
    with pytest.raises(ValueError, match="radius"):
        simhash.link_table(nodes, radius)
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    with pytest.raises(ValueError, match="radius"):
        simhash.near_duplicates(docs, radius=radius)
