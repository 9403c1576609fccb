"""Exact distributed median against Python's statistics.median."""
import random
import statistics

from tessera.operators.quantiles import exact_median

from conftest import rows


def test_exact_median_skewed_groups(spark):
    rnd = random.Random(7)
    data = []
    for i in range(6000):                      # one hot group holds half the rows
        data.append(("hot", rnd.randint(0, 500)))
    for g in range(40):
        for _ in range(rnd.randint(1, 30)):
            data.append((f"g{g}", rnd.randint(-50, 50)))
    data += [("hot", None), ("nulls_only", None), (None, 5), (None, 8)]
    df = spark.createDataFrame(data, "g string, v int")
    got = dict(rows(exact_median(df, ["g"], "v", partitions=13)))
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    exp = {g: float(statistics.median(vs)) for g, vs in groups.items()}
    assert got == exp


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-20, 20))),
                min_size=1, max_size=80),
       st.integers(1, 9))
def test_exact_median_matches_python(spark, data, parts):
    df = spark.createDataFrame(data, "g string, v int")
    got = dict(rows(exact_median(df, ["g"], "v", partitions=parts)))
    groups = {}
    for g, v in data:
        groups.setdefault(g, [])
        if v is not None:
            groups[g].append(v)
    exp = {g: float(statistics.median(vs)) for g, vs in groups.items() if vs}
    assert {g: m for g, m in got.items() if m is not None} == exp
