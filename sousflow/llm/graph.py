"""Links between document classes: star candidates from shared buckets, verification, components.

Used by the operators that bucket signatures. Everything stays in Spark tables: buckets,
candidate pairs, links and component labels are never collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import bitmap_of, probe
from .common import frugal, staged

#: 512 bits of a class's odd sketch.
SKETCH_LONGS = 8


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"])
    return run


def odd_sketch(items: np.ndarray) -> list[int]:
    """Parity of the items that fall on each of ``64 * SKETCH_LONGS`` places, as signed 64-bit numbers.

    The sketch of a symmetric difference is the exclusive or of the two sketches, so the bits
    set in that never outnumber the items in which two sets differ.
    """
    odd = np.bincount((items >> np.uint64(23)) % np.uint64(64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def _may_reach(percent: int) -> Column:
    """Whether a pair (n, sketch) and (na, sketch_a) may reach the threshold: by size, and by a lower bound of the difference."""
    both = F.col("n") + F.col("na")
    allowed = both - 2 * F.floor((percent * both + 99 + percent) / (100 + percent))
    apart = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("sketch_a")[k])) for k in range(SKETCH_LONGS)), F.lit(0))
    return (100 * F.least("n", "na") >= percent * F.greatest("n", "na")) & (apart <= allowed)


def verified(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Of distinct pairs (a: hub, b) those whose full sets (cls, items: sorted 64-bit hashes) reach the Jaccard threshold.

    Every pair takes its member's set to its hub's; adaptive execution splits a hub with very
    many members, as both sides of that join come straight from their exchange.
    """
    pairs = staged(pairs, "pairs")
    sets = staged(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()), "sets")
    rows = pairs.join(sets.select(F.col("cls").alias("b"), F.col("items").alias("set_b")), "b")
    rows = rows.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("set_a")), "a")
    return rows.select("a", "b", "set_a", "set_b").mapInArrow(frugal(_overlaps(percent)), "a bigint, b bigint")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is itself a u."""
    ends = edges.select(F.col("u").alias("cls"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("cls"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("cls").agg(F.sum("up").alias("ups"), F.max("down").alias("down")).where("ups + down > 1 AND ups > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(cls, component) of every class that is not its component's smallest. Large-star and small-star in turn.

    The smallest neighbours of a round are written before they are joined, so a class with
    very many links is split among tasks.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u != v").distinct(), "large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = staged(small.where("u != v").distinct(), "edges")
    return edges.select(F.col("u").alias("cls"), F.col("v").alias("component"))


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> Callable:
    """A test of document ids in a task: true for all of ``wanted`` (cls) and, by chance, for a few others.

    Texts are filtered where they are read, so those of single documents are never shuffled.
    """
    ids = staged(wanted, "wanted")
    bits, slots = bitmap_of(ids.select(F.xxhash64("cls").alias("h")), ids.count())
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    return lambda keys: probe(keys, shared.value, slots)


def linked(members: DataFrame, classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and components among classes that share buckets, from distinct (bucket, cls) and (cls, n, sketch).

    The first round makes a star in every bucket, its hub against all other members that may
    reach the threshold by their sizes and odd sketches, which never leaves out a link. The
    hub is the member that shares buckets with most others, so the original of a group of
    copies is the hub of all its buckets. Links that hold on the full sets are merged into
    components, and the hub leaves its bucket. A bucket whose remaining members lie in one
    component is done. In the second round the few buckets that still join different components
    compare every member outside the component of most links with the members of other
    components, under the same filter. So every two classes that share a bucket have been
    compared or lie in one component.

    ``sets_of(classes)`` gives (cls, items) for at least the given distinct classes (cls).
    Returns links (a, b) and (cls, component) of the classes that are not their component's smallest.
    """
    sizes = staged(members.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    shared = staged(members.join(sizes, "bucket"), "shared")
    weight = staged(shared.groupBy("cls").agg(F.sum("m").alias("weight")), "weights")
    live = staged(shared.select("bucket", "cls").join(classes.join(weight, "cls"), "cls"), "live")
    hub = F.max(F.struct("weight", "cls", "n", "sketch")).alias("x")
    hubs = staged(live.groupBy("bucket").agg(hub).select("bucket", F.col("x.cls").alias("a"), F.col("x.n").alias("na"), F.col("x.sketch").alias("sketch_a")), "hubs")
    met = live.join(hubs, "bucket").where("cls != a").where(_may_reach(percent))
    links = staged(verified(met.select("a", F.col("cls").alias("b")).distinct(), sets_of, percent), "links")
    groups = staged(components(links), "groups")
    degree = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("degree"))
    known = staged(degree.join(groups, "cls", "left").select("cls", F.coalesce("component", "cls").alias("label"), "degree"), "known")
    rest = live.join(hubs.select("bucket", "a"), "bucket").where("cls != a").join(known, "cls", "left").select(
        "bucket", "cls", "n", "sketch", F.coalesce("label", "cls").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree"))
    rest = staged(rest, "rest")
    still = staged(rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(F.struct("degree", "cls", "component")).alias("best"))
                   .where("lo != hi").select("bucket", F.col("best.component").alias("main")), "open")
    if still.isEmpty():
        return links, groups
    live = staged(rest.join(still, "bucket").select("bucket", "cls", "component", "n", "sketch", (F.col("component") != F.col("main")).alias("hub")), "live")
    hubs = live.where("hub").select("bucket", F.col("cls").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("sketch").alias("sketch_a"))
    met = live.join(staged(hubs, "hubs"), "bucket").where("component != ca AND (NOT hub OR a < cls)").where(_may_reach(percent))
    found = staged(verified(met.select("a", F.col("cls").alias("b")).distinct(), sets_of, percent), "links")
    links = links.unionByName(found)
    return links, groups if found.isEmpty() else components(links)
