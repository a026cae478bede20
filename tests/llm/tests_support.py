"""Small inputs for the corpus tests."""

SF = "/root/testdata/sf0.001"


def documents(spark, name, sf=SF):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]
