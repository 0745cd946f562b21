"""Exact rank cuts: equal to the plain window, exact per-class counts, disjoint and covering."""

import random

import pyspark.sql.functions as F
from pyspark.sql import Window

from riskframe.functions.hashing import order_hash
from riskframe.operators.rank import assign_by_rank, intervals_from_sizes
from riskframe.operators.split import partition_clients, stratified_split, subsample


def _frame(spark, n=3000, pos_share=0.1, seed=7):
    rnd = random.Random(seed)
    rows = [(i, 1 if rnd.random() < pos_share else 0) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, label int")


def test_assign_by_rank_equals_window_with_ties(spark):
    df = _frame(spark, 2000)
    # a coarse hash with many ties: the tiebreak must order them like the plain window
    d = df.withColumn("h", F.pmod(F.col("row_id") * 7919, F.lit(97)) * F.lit(2**25))
    cuts = [0, 137, 501, 1000]

    def segs(totals):
        sizes = F.array(*[F.lit(b - a) for a, b in zip(cuts, cuts[1:])], F.col("n") - F.lit(cuts[-1]))
        return intervals_from_sizes(totals, [], sizes, F.array(*[F.lit(i) for i in range(len(cuts))]), "seg")

    got = {r["row_id"]: r["seg"] for r in assign_by_rank(d, hash_col="h", tiebreak="row_id", segments=segs, level_bits=(2, 2, 3), window_rows=40).collect()}
    w = Window.orderBy("h", "row_id")
    ranked = d.withColumn("rk", F.row_number().over(w)).collect()
    for r in ranked:
        expect = sum(1 for c in cuts[1:] if r["rk"] > c)
        assert got[r["row_id"]] == expect
    assert len(got) == 2000


def test_stratified_split_counts_and_coverage(spark):
    df = _frame(spark, 3001)
    out = stratified_split(df).collect()
    assert len(out) == 3001 and len({r["row_id"] for r in out}) == 3001
    for label in (0, 1):
        n = sum(1 for r in out if r["label"] == label)
        t = n * 70 // 100
        v = (n - t) * 50 // 100
        got = {s: sum(1 for r in out if r["label"] == label and r["split"] == s) for s in ("train", "val", "test")}
        assert got == {"train": t, "val": v, "test": n - t - v}


def test_split_is_independent_of_partitioning(spark):
    df = _frame(spark, 1500)
    a = {r["row_id"]: r["split"] for r in stratified_split(df).collect()}
    b = {r["row_id"]: r["split"] for r in stratified_split(df.repartition(13)).collect()}
    assert a == b


def test_iid_partitions_are_ntile(spark):
    df = _frame(spark, 1001)
    out = partition_clients(df, "iid").collect()
    sizes = sorted((sum(1 for r in out if r["client_id"] == c) for c in ("w1", "w2", "w3")), reverse=True)
    assert sizes == [334, 334, 333]
    for c in ("w1", "w2", "w3"):
        n = sum(1 for r in out if r["client_id"] == c)
        assert sum(1 for r in out if r["client_id"] == c and r["local_split"] == "train") == int(0.85 * n)


def test_noniid_orders_by_label(spark):
    df = _frame(spark, 900, 0.2)
    out = partition_clients(df, "noniid").collect()
    # all negatives come before all positives in the client order
    max_neg_client = max(r["client_id"] for r in out if r["label"] == 0)
    min_pos_client = min(r["client_id"] for r in out if r["label"] == 1)
    assert max_neg_client <= min_pos_client


def test_bank_mix_shares(spark):
    df = _frame(spark, 2000, 0.2)
    out = partition_clients(df, "bank_noniid").collect()
    n_pos = sum(1 for r in out if r["label"] == 1)
    n_neg = len(out) - n_pos
    pos = {c: sum(1 for r in out if r["label"] == 1 and r["client_id"] == c) for c in ("w1", "w2", "w3")}
    neg = {c: sum(1 for r in out if r["label"] == 0 and r["client_id"] == c) for c in ("w1", "w2", "w3")}
    assert pos["w1"] == int(n_pos * 0.15) and pos["w2"] == int(n_pos * 0.30)
    assert neg["w1"] == int(n_neg * 0.45) and neg["w2"] == int(n_neg * 0.35)
    assert sum(pos.values()) == n_pos and sum(neg.values()) == n_neg


def test_subsample_exact_size(spark):
    df = _frame(spark, 1000)
    assert subsample(df, 250).count() == 250
    assert subsample(df, 0).count() == 1000
    assert subsample(df, 5000).count() == 1000


def test_order_hash_matches_python(spark):
    import hashlib

    got = spark.range(5).select(order_hash("id", 42).alias("h")).collect()
    for i, r in enumerate(got):
        assert r["h"] == int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16)


def test_multilevel_with_strata_and_lead_equals_window(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.randint(0, 1), rnd.randint(0, 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, s int, g int").withColumn("h", order_hash("row_id", 5))

    def segs(totals):
        t = F.floor(F.col("n") * 0.3).cast("bigint")
        u = F.floor(F.col("n") * 0.55).cast("bigint")
        return intervals_from_sizes(totals, ["s"], F.array(t, u - t, F.col("n") - u), F.array(F.lit(0), F.lit(1), F.lit(2)), "seg")

    out = assign_by_rank(df, hash_col="h", tiebreak="row_id", segments=segs, strata=["s"], lead=["g"],
                         level_bits=(3, 3, 3), window_rows=25)
    got = {r["row_id"]: r["seg"] for r in out.collect()}
    w = Window.partitionBy("s").orderBy("g", "h", "row_id")
    ranked = df.withColumn("rk", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("s")))
    for r in ranked.collect():
        t, u = int(r["n"] * 0.3), int(r["n"] * 0.55)
        assert got[r["row_id"]] == (0 if r["rk"] <= t else 1 if r["rk"] <= u else 2)
    assert len(got) == 3000


def test_ordered_row_number_equals_window(spark):
    from riskframe.operators.rank import ordered_row_number

    rnd = random.Random(5)
    vals = rnd.sample(range(100000), 2500)
    rows = [(v, f"g{rnd.randint(0, 2)}") for v in vals]
    df = spark.createDataFrame(rows, "v long, g string")
    got = {r["v"]: r["rn"] for r in ordered_row_number(df, ["g"], "v", buckets=16).collect()}
    want = {r["v"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v"))).collect()}
    assert got == want
