"""Marks of likely members."""

from pyspark.sql import functions as F

from thicket.llm.shared import mark_likely


def test_all_members_are_marked(spark):
    df = spark.range(-500, 5000).withColumn("_bits", F.lit(1)).repartition(3)
    ids = df.filter("id % 10 = 0").select("id")
    got = mark_likely(df, "id", ids, "likely").collect()
    assert len(got) == 5500 and all(r["likely"] for r in got if r["id"] % 10 == 0)
    assert sum(r["likely"] for r in got) < 600
    assert not any(r["likely"] for r in mark_likely(df, "id", ids.limit(0), "likely").collect())
    none = spark.createDataFrame([(None,), (1,)], "id long")
    assert [r["likely"] for r in mark_likely(none, "id", none.limit(0), "likely").collect()] == [False, False]
