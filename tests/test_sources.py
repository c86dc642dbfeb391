"""Readers of catalog tables and CSV files, and the probe of catalog names."""

from vatlens.sources.tables import read_catalog, read_csv, table_exists, write_csv


def test_catalog_reader_and_probe(spark):
    spark.range(5).selectExpr("id", "id * 2 AS twice").createOrReplaceTempView("known_source")
    try:
        assert table_exists(spark, "known_source")
        assert not table_exists(spark, "unknown_source")
        assert sorted(map(tuple, read_catalog(spark, "known_source").collect())) == [(i, 2 * i) for i in range(5)]
    finally:
        spark.catalog.dropTempView("known_source")


def test_csv_round_trip_keeps_types_and_nulls(spark, tmp_path):
    schema = "id long, name string, amount decimal(18,2)"
    rows = spark.sql("SELECT * FROM VALUES (1L, 'a, \"b\"', 1.50BD), (2L, NULL, NULL) AS t(id, name, amount)") \
        .selectExpr("id", "name", "CAST(amount AS decimal(18,2)) AS amount")
    write_csv(rows, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), schema)
    assert back.dtypes == rows.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
