"""Keys of line dedup are counted and paired a slice at a time: no more than a slice of the key rows is stored or shuffled at once."""

from pyspark.sql import functions as F

from riskframe.llm import components


def test_slices_meet_every_pair_once(spark, monkeypatch):
    stored, plain = [], components.staged

    def counting(df, what="stage"):
        out = plain(df, what)
        stored.append((what, out.count()))
        return out

    monkeypatch.setattr(components, "staged", counting)
    # Key k is shared by 2 + k % 4 items next to each other, one key by all, the others by one item alone.
    rows, at = [], 0
    for k in range(200):
        for i in range(2 + k % 4):
            rows.append((at, [k, 10_000 + at, -1], 10 * k + i))
            at += 1
    items = spark.createDataFrame(rows, "id long, keys array<long>, place int").withColumn("tens", F.floor(F.col("place") / 1000))
    label = components.link_buckets(items, ["place"], lambda l, r: F.abs(l("place") - r("place")) <= 1, lambda p: p.select("a", "b"), sparse=True,
                                    light=["tens"], maybe=lambda l, r: F.abs(l("tens") - r("tens")) <= 1)
    first = {}
    for i, (k, *_), _ in rows:
        first.setdefault(k, i)
    assert {(r["id"], r["comp"]) for r in label.collect()} == {(i, first[k]) for i, (k, *_), _ in rows}
    shared = [n for what, n in stored if what == "shared"]
    assert len(shared) == components.SLICES and sum(shared) == 2 * at  # each once: its key of few and the key of all
    of_few = sorted(n for n in shared)[: components.SLICES - 1]
    assert max(of_few) < at / 2
    large = [n for what, n in stored if what == "large"]
    assert large[-1] == at and "buckets" not in {what for what, _ in stored}
