import pytest
from pyspark.sql import functions as F

from storecast.functions import portable_hash
from storecast.operators.sampling import append_copies, exact_sample


def lowest(n, wanted):
    def order(key):
        return ((key % 2**31) * 2654435761 % 2**32, key)

    return sorted(sorted(range(n), key=order)[:wanted])


# Sorting only what is undecided must not change the choice, however small that is.
@pytest.mark.parametrize("sorted_rows", [0, 1, 10, 100_000])
@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.03, 0.5, 0.999, 1.0])
def test_exact_size_and_choice(spark, fraction, sorted_rows):
    df = spark.range(20_000)
    got = exact_sample(df, fraction, "id", portable_hash(F.col("id")), sorted_rows)
    assert sorted(r.id for r in got.collect()) == lowest(20_000, int(20_000 * fraction))


def test_hash_collisions_are_cut_by_key(spark):
    got = exact_sample(spark.range(100), 0.25, "id", F.lit(5).cast("long"), 0)
    assert sorted(r.id for r in got.collect()) == list(range(25))


def test_default_hash_and_copies(spark):
    df = spark.range(1000)
    assert exact_sample(df, 0.1, "id").count() == 100
    copied = append_copies(df, 0.02, "id")
    assert copied.count() == 1020
    assert copied.distinct().count() == 1000


def test_nothing_to_sample(spark):
    assert exact_sample(spark.range(0), 0.5, "id").count() == 0
