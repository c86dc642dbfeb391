import numpy as np
import pytest
from pyspark.sql import functions as F

from vatlens.operators.ownership import opacity_quartiles


@pytest.mark.parametrize("partitions,adaptive", [(4, "true"), (16, "false")])
def test_quartiles_of_many_rows(spark, partitions, adaptive):
    """Several range partitions: bounds are sampled once, so ranks and offsets belong together."""
    values = np.random.default_rng(3).random(100_000).round(5)
    df = spark.createDataFrame(list(enumerate(values.tolist())), "company long, value double").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = opacity_quartiles(df.where(F.col("value") >= 0), partitions=partitions).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert [got.q25, got.q50, got.q75] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist(), abs=1e-12)
