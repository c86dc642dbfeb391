"""Exact distributed quartiles against numpy's linear interpolation."""

import numpy as np
import pytest

from vatlens.operators.ownership import opacity_quartiles


@pytest.mark.parametrize("values", [
    [0.5],
    [0.1, 0.9],
    [0.3, 0.1, 0.2, 0.5, 0.4],
    [0.0] * 40 + [round(0.01 * i, 2) for i in range(80)],   # one value holds a third of the rows
])
def test_quartiles_match_numpy(spark, values):
    rows = [(i, v) for i, v in enumerate(values)] + [(len(values), None)]
    df = spark.createDataFrame(rows, "company long, value double")
    got = opacity_quartiles(df, partitions=4).collect()[0]
    want = np.percentile(np.array(values), [25, 50, 75])
    assert [round(x, 9) for x in (got.q25, got.q50, got.q75)] == [round(float(x), 9) for x in want]


def test_quartiles_empty(spark):
    df = spark.createDataFrame([(1, None)], "company long, value double")
    got = opacity_quartiles(df, partitions=4).collect()[0]
    assert got.q25 is None and got.q75 is None
