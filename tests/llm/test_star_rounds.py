"""Stars from ever other hubs: exact components, and no pairs of a family whose smallest id is at its edge."""

from pyspark.sql import functions as F

from riskframe.llm.components import link_buckets


def linked(spark, rows, reach):
    """{id: component} of ``rows`` (id, keys, place), and how many pairs were verified."""
    tried = []

    def verify(pairs):
        tried.append(pairs.count())
        return pairs.select("a", "b").distinct()

    items = spark.createDataFrame(rows, "id long, keys array<long>, place long")
    label = link_buckets(items, ["place"], lambda l, r: F.abs(l("place") - r("place")) <= reach, verify, sparse=True)
    found = {r["id"]: r["comp"] for r in label.collect()}
    return {i: found.get(i, i) for i, _, _ in rows}, sum(tried)


def brute(rows, reach):
    group = {i: i for i, _, _ in rows}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, keys, place in rows:
        for j, others, there in rows:
            if i < j and set(keys) & set(others) and abs(place - there) <= reach and root(i) != root(j):
                group[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in group}


def test_hub_at_the_edge(spark):
    rows = [(0, [1], 10_000)] + [(i, [1, 2 + i % 3], i * 7919 % 97) for i in range(1, 400)]
    got, tried = linked(spark, rows, 100)
    assert got == brute(rows, 100) and len(set(got.values())) == 2
    assert tried < 2_000  # all pairs would be 79,401


def test_chains_and_strangers(spark):
    rows = [(i, [1, i % 7], i * 31 % 211 * 3) for i in range(60)]
    got, _ = linked(spark, rows, 9)
    assert got == brute(rows, 9)
