"""A key holding a third of all rows: the prior-year join is split by AQE and
the de-dup collapses the hot key map-side; results equal the unskewed run."""

from pyspark.sql import functions as F

from filing_release.operators.dedup import deduplicate, size_score
from filing_release.operators.history import prior_year_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


def test_hot_key_is_split(spark):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        cur = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("000000000"))
             .otherwise(F.lpad((F.col("id") % 20000).cast("string"), 9, "0")).alias("EIN"),
            F.lit(2015).alias("FISYR"), F.lit("201512").alias("TAXPER"),
            (F.col("id") % 997).cast("double").alias("TOTREV"), F.lit(1.0).alias("ASS_EOY"),
            F.lit(1.0).alias("EXPS"), F.col("id").alias("FILING_ID")).repartition(8)
        pri = spark.range(20000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("EIN"),
                                        F.lit(2014).alias("FISYR"), (F.col("id") * 1.0).alias("TOTREV"))
        out = deduplicate(prior_year_join(cur, pri), 2015, score=size_score(),
                          tiebreak=F.col("FILING_ID"))
        got = {r["EIN"]: r["FILING_ID"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len(got) == 20000
        # hot key: max TOTREV (996) first, then the largest id with that value
        want_hot = max(i for i in range(0, n, 3) if i % 997 == 996)
        assert got["000000000"] == want_hot
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_key_split_in_staged_lookup_join(spark):
    """A lookup reduced to one row per key and staged keeps the join
    splittable (an aggregate next to the join would not)."""
    from filing_release.operators import enrich
    from filing_release.plans.materialize import stage
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        ext = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("000000000"))
             .otherwise(F.lpad((F.col("id") % 20000).cast("string"), 9, "0")).alias("EIN"),
            F.col("id").alias("FILING_ID")).repartition(8)
        master = spark.range(40000).select(
            F.lpad((F.col("id") % 20000).cast("string"), 9, "0").alias("EIN"),
            F.col("id").cast("string").alias("NteeFinal"))
        lk = stage(enrich.one_row_per_key(enrich.classification_lookup(master)), "cls_test")
        out = enrich.left_enrich(ext, lk, "EIN")
        rows = out.groupBy("NTEEFINAL").count().collect()     # forces the join
        plan_df = out.select("EIN", "FILING_ID", "NTEEFINAL")   # a varying payload, as real rows
        plan_df.collect()
        assert "skew=true" in plan_df._jdf.queryExecution().executedPlan().toString()
        assert sum(r["count"] for r in rows) == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
