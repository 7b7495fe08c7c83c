"""Byte-level dedup deals its buckets evenly: a partition holds one of them, so a task's memory is that of one bucket."""

from pyspark.sql import functions as F

from terracat.llm import suffix_dedup as S


def test_a_partition_holds_one_bucket(spark):
    rows = spark.range(600).select(F.col("id").alias("uid"), F.encode(F.lit("text"), "UTF-8").alias("body"))
    packed = spark.range(51).select(F.col("id").cast("int").alias("to"), F.lit(S.COVERED).alias("kind"), *[F.lit(None).cast("binary").alias(c) for c in ("uid", "count", "lo", "size", "key", "more", "body")])
    dealt = S._with_docs(rows, packed, 51).select("to", "kind", F.spark_partition_id().alias("part"))
    got = dealt.groupBy("part").agg(F.countDistinct("to").alias("buckets"), F.count("*").alias("n")).collect()
    assert len(got) == 51 and {r["buckets"] for r in got} == {1} and sum(r["n"] for r in got) == 651
    kinds = [r["kind"] for r in dealt.where("part = 7").collect()]
    assert kinds == sorted(kinds) and kinds.count(S.COVERED) == 1
