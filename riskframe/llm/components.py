"""Connected components of an edge table, and exact linking of bucketed items without all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import discard, remove, shared_path, staged, write_stage

# Rounds of stars from ever other hubs before pairs of what is left are taken.
STAR_ROUNDS = 6
# Items of a key up to which its pairs are compared at once, without rounds of stars: at most seven and a half pairs an item.
FEW = 16
# Parts of the keys that are counted and met one after the other, so that the shuffles of one part alone are on disk.
SLICES = 4


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """``(id, comp)`` for every id that occurs in ``edges(a, b)``: comp is the smallest id reachable.

    Alternating large-star and small-star rounds (minimum of neighbours, then re-hang), each a partial
    aggregation and a join that adaptive execution may split, staged in the shared folder per round.
    Null ends and loops are ignored; an empty table gives an empty one.
    """
    spark = edges.sparkSession

    def write(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = shared_path(spark, what)
        write_stage(df, path)
        back = spark.read.schema("u long, v long").parquet(path)
        state = back.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return back, path, tuple(state)

    e, path, state = write(edges.where("a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct())
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large, lpath, _ = write(large)
        low2 = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(low2, F.col("u") == F.col("k"))
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e, new_path, new_state = write(small)
        remove(spark, lpath)
        remove(spark, path)
        path = new_path
        if new_state == state:
            break
        state = new_state
    return (e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("comp"))).distinct())


def joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label(id, comp)``, stored, after ``links(p, q)`` between components, of which those of one item need no row: a walk over what the links touch, not over all labels."""
    now = staged(components(links.select(F.col("p").alias("a"), F.col("q").alias("b"))).select(F.col("id").alias("old"), F.col("comp").alias("new")), "now")
    moved = label.join(now, F.col("comp") == F.col("old"), "left").select("id", F.coalesce("new", "comp").alias("comp"))
    alone = now.join(label, F.col("old") == F.col("id"), "left_anti").select(F.col("old").alias("id"), F.col("new").alias("comp"))
    return staged(moved.unionByName(alone), "labels")


def _stars(rows: DataFrame, plain: DataFrame, payload: Sequence[str], label: DataFrame, near: Callable[[Callable, Callable], Column],
           verify: Callable[[DataFrame], DataFrame], light: Sequence[str], maybe: Callable[[Callable, Callable], Column]) -> tuple[DataFrame, DataFrame]:
    """More rounds of stars over the staged ``rows(key, id, *light)``, which go once read: the labels after them, and ``(key, id, comp, *light)`` of the keys
    that several components still share.

    A key that one component has to itself stays so, hence every round looks only at the keys the one before left open.
    """
    side = lambda at: plain.select(F.col("id").alias(at), F.struct(*payload).alias(f"of_{at}"))
    left, turn = rows, 0
    while True:
        # Joined twice rather than stored: the labels are few beside the rows.
        held = (left.select("key", "id", *light).join(label.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
                .select("key", "id", F.coalesce("comp", "id").alias("comp"), *light))
        mixed = held.groupBy(F.col("key").alias("mixed")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("mixed")
        still = staged(held.join(mixed, F.col("key") == F.col("mixed"), "left_semi"), "open")
        discard(left)
        left, turn = still, turn + 1
        if turn > STAR_ROUNDS or left.isEmpty():
            return label, left
        hubs = left.groupBy(F.col("key").alias("hub_key")).agg(F.min_by(F.struct("id", "comp", *light), F.xxhash64("id", F.lit(turn))).alias("hub"))
        pairs = (left.join(hubs, F.col("key") == F.col("hub_key")).where("comp <> hub.comp").where(maybe(F.col, lambda c: F.col(f"hub.{c}")))
                 .select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"),
                         F.least("comp", "hub.comp").alias("p"), F.greatest("comp", "hub.comp").alias("q")).distinct())
        tried = staged(pairs.join(side("a"), "a").join(side("b"), "b").where(near(lambda c: F.col(f"of_a.{c}"), lambda c: F.col(f"of_b.{c}")))
                       .groupBy("p", "q").agg(F.min_by(F.struct("a", "b"), F.xxhash64("a", "b", F.lit(turn))).alias("x")).select("x.a", "x.b", "p", "q"), "tried")
        links = staged(verify(tried.select("a", "b")).join(tried, ["a", "b"]).select("p", "q"), "links")
        discard(tried)
        if links.isEmpty():
            return label, left
        label = joined(label, links)


def _met(items: DataFrame, light: Sequence[str], maybe: Callable[[Callable, Callable], Column]) -> tuple[DataFrame, DataFrame]:
    """``(a, b)``, a < b, of items that share a key of up to ``FEW`` items or, under a key of more, that of its smallest id, and hold ``maybe``; and the staged
    ``(key, id, *light)`` of the keys of more items.

    One slice of the keys after the other is exploded, counted and paired, and only its pairs and the rows of its large keys stay."""
    pairs, large = [], []
    for part in range(SLICES):
        rows = items.select("id", *light, F.explode("keys").alias("key")).where(F.pmod(F.xxhash64("key"), F.lit(SLICES)) == part)
        # Most keys have one item: counting moves the key alone.
        shared = rows.groupBy(F.col("key").alias("shared")).agg(F.count("*").alias("c")).where("c > 1")
        held = staged(rows.join(shared.hint("shuffle_hash"), F.col("key") == F.col("shared")).select("key", "id", *light, "c"), "shared")
        few = held.where(F.col("c") <= FEW)
        l, r = few.alias("l"), few.alias("r")
        pairs.append(staged(l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.id") < F.col("r.id")) & maybe(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}")))
                            .select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct(), "few"))
        large.append(staged(held.where(F.col("c") > FEW).select("key", "id", *light), "large"))
        discard(held)
    more = staged(reduce(DataFrame.unionByName, large), "large")
    hubs = more.groupBy(F.col("key").alias("hub_key")).agg(F.min(F.struct("id", *light)).alias("hub"))
    star = (more.join(hubs, F.col("key") == F.col("hub_key")).where("id <> hub.id").where(maybe(F.col, lambda c: F.col(f"hub.{c}")))
            .select(F.col("hub.id").alias("a"), F.col("id").alias("b")))
    met = staged(reduce(DataFrame.unionByName, [*pairs, star]).distinct(), "met")
    discard(*pairs, *large)
    return met, more


def link_buckets(items: DataFrame, payload: Sequence[str], near: Callable[[Callable, Callable], Column],
                 verify: Callable[[DataFrame], DataFrame], *, sparse: bool = False, light: Sequence[str] = (),
                 maybe: Callable[[Callable, Callable], Column] = lambda l, r: F.lit(True)) -> DataFrame:
    """``(id, comp)`` of all linked items of ``items(id, keys array<long>, *payload)``, exactly.

    The graph: two items share a key, are ``near`` by their payloads and pass ``verify``.  Round one links each item
    of a bucket to one hub, a star instead of all pairs.  A hub at the edge of a family of near copies reaches few of them, so
    more rounds follow over the keys that several components still share, each from another hub of every key (the
    smallest hash of id and round) and with one pair for each two components, until a round finds no link or ``STAR_ROUNDS`` are done.
    A pair whose two items are then in one component cannot change the result, so the last step compares all items of different components,
    inside the join, where only ``near`` pairs become rows; it is exact whatever the rounds found.  Joins are on the key, which adaptive
    execution splits when it is hot.

    ``verify`` gets distinct pairs (a, b) and returns the linked ones.  ``sparse``: most keys have one item, so those rows
    are dropped first and every bucket gets a star from its smallest id; rows of ``items`` may repeat.  Keys of up to
    ``FEW`` items need no rounds: the last step compares their pairs, in proportion to their items.  With ``light``, columns of ``items``, whose ids are then distinct,
    these columns travel with the keys, ``maybe`` of them, which holds for every ``near`` pair, spares most others the joins with the payloads, and the pairs of
    keys of up to ``FEW`` items are taken at once, a slice of the keys after the other.  Otherwise most keys
    are shared by chance and ids are distinct: stars use the more selective keys of a further column ``stars``, and a hub
    is the item of the smallest payload (one column).
    """
    plain = items.select("id", *payload)
    side = lambda at: plain.select(F.col("id").alias(at), F.struct(*payload).alias(f"of_{at}"))
    close = lambda pairs: (pairs.join(side("a"), "a").join(side("b"), "b")
                           .where(near(lambda c: F.col(f"of_a.{c}"), lambda c: F.col(f"of_b.{c}"))).select("a", "b"))
    if light:
        plain = items.select("id", *dict.fromkeys([*light, *payload]))
        star, large = _met(items, light, maybe)
        met = staged(close(star), "met")
        discard(star)
        star = met
    elif sparse:
        rows = items.select("id", F.explode("keys").alias("key"))
        # Most keys have one item: counting moves the key alone.
        shared = rows.groupBy(F.col("key").alias("shared")).agg(F.count("*").alias("c")).where("c > 1").select("shared")
        rows = rows.join(shared.hint("shuffle_hash"), F.col("key") == F.col("shared"), "left_semi").dropDuplicates(["key", "id"])
        plain = staged(items.select("id", *payload).dropDuplicates(["id"]), "items")
        several = staged(rows, "shared")
        hubs = several.groupBy(F.col("key").alias("hub_key")).agg(F.min("id").alias("hub"), F.count("*").alias("c")).where("c > 1")
        rows = staged(several.join(hubs, F.col("key") == F.col("hub_key")).select("key", "id", "hub", "c"), "buckets")
        discard(several)
        met = staged(close(rows.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()), "met")
        star = met
    else:
        (value,) = payload
        rows = items.select("id", F.explode("stars").alias("key"), value)
        hubs = (rows.groupBy(F.col("key").alias("hub_key")).agg(F.count("*").alias("c"), F.min(value).alias("hub_value"))
                .where("c > 1").drop("c"))
        heads = plain.groupBy(F.col(value).alias("hub_value")).agg(F.min("id").alias("hub"))
        star = (rows.join(hubs, F.col("key") == F.col("hub_key"))
                .where(near(lambda c: F.col(c), lambda c: F.col("hub_value"))).select("id", "hub_value").distinct()
                .join(heads, "hub_value").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")))
    # Members of a family meet several hubs, one per key: the smallest near one is enough, round two sees to the rest.
    star = staged(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    label = staged(components(verify(star)), "labels")

    now = lambda at: label.select(F.col("id").alias(at), F.col("comp").alias(f"now_{at}"))
    apart = lambda pairs: (pairs.join(now("a"), "a", "left").join(now("b"), "b", "left")
                           .select("a", "b", F.coalesce("now_a", "a").alias("ca"), F.coalesce("now_b", "b").alias("cb")).where("ca <> cb")
                           .select("a", "b", F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")))
    if light:
        label, open_keys = _stars(large, plain, payload, label, near, verify, light, maybe)
        rest = open_keys.select("key", "id", "comp").join(plain.select("id", *payload), "id")
    elif sparse:
        large = staged(rows.where(F.col("c") > FEW).select("key", "id"), "large")
        label, open_keys = _stars(large, plain, payload, label, near, verify, light, maybe)
        # The star of a key of two items was all of it.
        few = (rows.where(F.col("c").between(3, FEW)).select("key", "id").join(label.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
               .select("key", "id", F.coalesce("comp", "id").alias("comp")))
        rest = open_keys.select("key", "id", "comp").unionByName(few).join(plain.select("id", *payload), "id")
    else:
        rest = (items.join(label.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").drop("of")
                .select("id", F.coalesce("comp", "id").alias("comp"), F.explode("keys").alias("key"), value))
    l, r = rest.alias("l"), rest.alias("r")
    a_first = F.col("l.id") < F.col("r.id")
    pick = lambda c: [F.when(a_first, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")), F.when(a_first, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}"))]
    ends, sides = pick("id"), pick("comp")
    cross = (l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.comp") < F.col("r.comp"))
                    & near(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}")))
             .select(ends[0].alias("a"), ends[1].alias("b"), F.least(*sides).alias("ca"), F.greatest(*sides).alias("cb")).distinct())
    done = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if light or sparse:
        cross = cross.unionByName(apart(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))).distinct()
    cross = staged(cross.join(done, ["a", "b"], "left_anti"), "pairs")
    if light or sparse:
        discard(open_keys, met, *([] if light else [rows]))
    # One pair for each two components first: where it holds, all their other pairs are settled.  Then the pairs that are left.
    for last in (False, False, True):
        if cross.isEmpty():
            return label
        tried = cross if last else staged(cross.groupBy("ca", "cb").agg(F.min(F.struct("a", "b")).alias("x")).select("x.a", "x.b", "ca", "cb"), "first-pairs")
        more = staged(verify(tried.select("a", "b")).join(tried, ["a", "b"]).select(F.col("ca").alias("p"), F.col("cb").alias("q")), "links")
        if not more.isEmpty():
            label = joined(label, more)
        if not last:
            cross = staged(apart(cross.join(tried, ["a", "b"], "left_anti").select("a", "b")), "pairs")
    return label
