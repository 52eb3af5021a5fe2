from pyspark.sql import functions as F

from skyfold.operators import quality as Q
from skyfold.sources import readers as RD


def test_seed_bundled_and_csv_agree(spark, tmp_root):
    bundled = RD.read_seed(spark)
    path = f"{tmp_root}/seed/city_reference.csv"
    lines = RD.CITY_REFERENCE_CSV.strip().splitlines()
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1).write.text(path)
    from_csv = RD.read_seed(spark, path)
    assert bundled.count() == from_csv.count() == 20
    assert sorted(bundled.collect()) == sorted(from_csv.collect())


def test_seed_data_tests_pass(spark):
    seed = RD.read_seed(spark)
    res = Q.not_null(seed, "city_reference", ["city_id"]).unionByName(
        Q.unique(seed, "city_reference", "city_id"))
    assert {r.status for r in res.collect()} == {"pass"}


def test_active_cities_projection(spark):
    seed = RD.read_seed(spark).withColumn(
        "is_active", F.when(F.col("country") == "JP", 0).otherwise(F.col("is_active")))
    act = RD.active_cities(seed)
    assert act.columns == ["latitude", "longitude"]
    assert act.count() == 14
