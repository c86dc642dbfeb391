"""Hot keys are salted, never dropped: results equal a direct computation."""

import math

from vatlens.operators import contamination as con
from vatlens.plans.skew import SALT, hot_keys, salt_big, salt_small


def test_hot_keys_are_bounded_and_found(spark):
    rows = [(1, r) for r in range(300)] + [(k, 1000 + k) for k in range(2, 60)]
    df = spark.createDataFrame(rows, "issuer long, receiver long")
    hot = {r["issuer"]: r["_nsalt"] for r in hot_keys(df, ["issuer"], partitions=4).collect()}
    assert list(hot) == [1] and 1 < hot[1] <= 4
    big = salt_big(df, ["issuer"], hot_keys(df, ["issuer"], partitions=4), ["receiver"])
    assert big.count() == df.count()                                  # nothing dropped
    assert big.where("issuer = 1").select(SALT).distinct().count() > 1  # spread over buckets
    small = salt_small(spark.createDataFrame([(1, 0.5), (2, 0.1)], "issuer long, s double"),
                       ["issuer"], hot_keys(df, ["issuer"], partitions=4))
    assert small.where("issuer = 1").count() == hot[1] and small.where("issuer = 2").count() == 1


def test_propagation_with_a_hub_issuer_matches_direct_rounds(spark):
    edges = [(1, r, 0.5) for r in range(10, 400)] + [(2, 10, 0.25), (10, 11, 1.0)]
    s = spark.createDataFrame(edges, "issuer long, receiver long, fi double")
    fz = con.edge_strength(s)
    seeds = spark.createDataFrame([(1, 1), (2, 1)], "id long, score int")
    init = con.contam_init(con.trade_nodes(fz), seeds)
    got = {r["id"]: r["score"] for r in con.contam_propagate(fz, init, rounds=4, stop_when_stable=False).collect()}
    e = [(r["issuer"], r["receiver"], r["f0"], r["f"]) for r in fz.collect()]
    score = {r["id"]: r["score"] for r in init.collect()}
    for _ in range(4):
        s1, f0 = {}, {}
        for i, rcv, z, f in e:
            s1[rcv] = s1.get(rcv, 0.0) + f * score[i]
            f0[rcv] = z
        score = {k: max(v, s1[k] + f0[k] * v) if k in s1 else v for k, v in score.items()}
    assert got.keys() == score.keys()
    assert all(math.isclose(got[k], score[k], rel_tol=1e-9, abs_tol=1e-12) for k in got)
