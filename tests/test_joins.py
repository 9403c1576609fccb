"""The broadcast check measures the stored side."""
from tessera.operators.joins import broadcast_if_small


def test_long_strings_fall_back_to_the_shuffle_join(spark):
    long = spark.range(1000).selectExpr("id", "repeat('x', 200000) AS s")
    assert broadcast_if_small(long)[1] is False
    assert broadcast_if_small(long.limit(10))[1] is True


def test_nested_values_count(spark):
    nested = spark.range(100).selectExpr("id", "array_repeat(id, 20000) AS a")
    assert broadcast_if_small(nested, max_bytes=1 << 20)[1] is False
    assert broadcast_if_small(nested.limit(0))[1] is True
