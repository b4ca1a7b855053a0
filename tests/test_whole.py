"""Queries that must see every row."""

from pyspark.sql import functions as F

import __spark_entry__


def test_accepted_judges_every_row(spark):
    d = "/root/testdata/sf0.01"
    got = __spark_entry__.queries()["accepted"](spark, d).collect()
    ids = spark.read.parquet(f"{d}/instruction_rows.parquet").where("id is not null").agg(F.count_distinct("id")).first()[0]
    assert len(got) == len({r.id for r in got}) == ids and sorted(r["rank"] for r in got) == list(range(1, ids + 1))
