"""Input folders and row helpers shared by the test modules (never imported from a conftest)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(spark, values, schema="row_id long, h string"):
    return spark.createDataFrame(list(values), schema)
