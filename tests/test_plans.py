"""Plan shape: tables reused by every round are shuffled once, not per round."""

from pyspark.sql import functions as F

from vatlens.plans.iterate import cut, cut_partitioned


def _executed(df) -> str:
    """The final plan of ``df``, from the query execution that ran."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    plan = run.executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    return plan.split("== Initial Plan ==")[0]


def test_cut_partitioned_advertises_hash_partitioning(spark):
    big = spark.range(20000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    kept = cut_partitioned(big, "k")
    part = kept._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    assert part.startswith("hashpartitioning(k")
    # a plain checkpoint under AQE does not advertise it
    plain = cut(big.repartition("k"))
    assert "hashpartitioning" not in plain._jdf.queryExecution().executedPlan().outputPartitioning().toString()


def test_round_join_shuffles_only_the_small_side(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as with large node tables
    try:
        big = spark.range(20000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
        edges = cut_partitioned(big, "k")
        nodes = cut(spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")))
        plan = _executed(edges.join(nodes, "k").groupBy("k").agg(F.sum(F.col("v") * F.col("w"))))
        assert plan.count("Exchange hashpartitioning") == 1          # the nodes only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _big_side_exchanges(spark, rows):
    from vatlens.plans.skew import find_hot_keys, salt_big, salt_keys, salt_small
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = spark.createDataFrame(rows, "issuer long, receiver long, f double")
        hot = find_hot_keys(e, ["issuer"])
        ed = cut_partitioned(salt_big(e, ["issuer"], hot, ["receiver"]), *salt_keys(["issuer"], hot))
        src = cut(spark.range(1, 600).select(F.col("id").alias("issuer"), F.lit(1.0).alias("s")))
        j = ed.join(salt_small(src, ["issuer"], hot), salt_keys(["issuer"], hot), "inner")
        return hot, _executed(j.groupBy("receiver").agg(F.sum(F.col("f") * F.col("s"))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_salted_edges_are_not_reshuffled_without_hot_keys(spark):
    hot, plan = _big_side_exchanges(spark, [(i % 500 + 1, i, 0.5) for i in range(5000)])
    assert hot is None
    assert plan.count("Exchange hashpartitioning") == 2          # the small side and the aggregate


def test_salted_edges_are_not_reshuffled_with_a_hot_key(spark):
    hot, plan = _big_side_exchanges(spark, [(1, i, 0.5) for i in range(3000)]
                                    + [(i % 500 + 2, i, 0.5) for i in range(2000)])
    assert hot is not None
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_contamination_round_has_one_exchange(spark):
    """Edges and state lie by the same buckets: without salt only the sums per receiver move."""
    from vatlens.operators.contamination import contam_round
    from vatlens.plans.iterate import bucketed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        edges = bucketed(spark.range(5000).select((F.col("id") % 500).alias("issuer"), (F.col("id") % 491).alias("receiver"), F.lit(0.5).alias("f")), ["issuer"], n)
        state = bucketed(spark.range(500).select("id", F.lit(0.1).alias("score"), F.lit(0.2).alias("f0"), F.lit(True).alias("has_in"), F.lit(False).alias("changed")), ["id"], n)
        once = contam_round(edges, state)
        assert _executed(once).count("Exchange ") == 1
        again = bucketed(once, ["id"], n, placed=True)          # written where it lies, and still one
        assert _executed(contam_round(edges, again)).count("Exchange ") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reused_tables_leave_the_session_alone(spark, monkeypatch):
    """No setting is changed while a reused table is written: what is planned meanwhile keeps AQE."""
    kind, seen = type(spark.conf), []
    for name in ("set", "unset"):
        monkeypatch.setattr(kind, name, lambda self, key, *a, f=getattr(kind, name): (seen.append(key), f(self, key, *a))[1])
    kept = cut_partitioned(spark.range(1000).select((F.col("id") % 50).alias("k"), "id"), "k")
    assert kept.count() == 1000 and seen == [] and spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_hub_edges_are_split(spark):
    """Half of the ledger's edges on one issuer: the joins of the edge query with the declarations split it."""
    from vatlens.operators import credit as cr
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 8000
        docs = spark.range(n).repartition(8).select(
            F.lit(200006).alias("period"), F.when(F.col("id") < n // 2, 1).otherwise(F.col("id") % 700 + 2).cast("long").alias("issuer"), F.col("id").alias("receiver"),
            F.lit(1.0).alias("iva_fact"), F.lit(0.0).alias("iva_nc"), F.lit(1).alias("is_fact"), F.lit(0).alias("is_nc"), F.lit(1.0).alias("signed_vat"))
        decl1 = cut(spark.range(1, 600).select("id", F.lit(200006).alias("period")))
        edges = cr.trade_edges(cut(cr.trade_sums(docs)), decl1, summed=True)
        assert "skewed" in _executed(edges) or "skew=true" in _executed(edges)
        assert edges.where("issuer = 1").count() == n // 2 and edges.where("issuer_declares = 1").count() > n // 2
        assert "skew" in _executed(cr.trade_edges_clamped(edges))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
