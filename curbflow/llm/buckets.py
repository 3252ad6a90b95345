"""Buckets of candidates: which of their members meet in which task, and the links found there."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import drop_stored, spent, stored
from curbflow.llm.components import components

# Bytes of shingles of one bucket that meet in one task at most; larger buckets are cut into blocks.
BLOCK_BYTES = 64 << 20


def dealt(keyed: DataFrame, block: int) -> DataFrame:
    """(band, x, y, digest): the members of every bucket with two or more of them, from distinct rows (digest, band).

    Of buckets with the same members one is kept. A bucket with more than `block` members is cut into blocks by digest, and
    every pair (x, y) of blocks is one task's work, so every pair of members still meets.
    """
    pairs = keyed = stored(keyed)
    mixed = F.xxhash64("digest")
    sets = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("count"), F.bit_xor(mixed).alias("xor"), F.bit_xor(F.xxhash64(mixed, "digest")).alias("other"))
    shared = stored(sets.filter("count > 1").groupBy("count", "xor", "other").agg(F.min("band").alias("band")))
    blocks = F.when(F.col("count") > block, F.ceil(2 * F.col("count") / block).cast("int")).otherwise(1)
    keyed = keyed.join(shared.select("band", blocks.alias("blocks")), "band")
    keyed = keyed.withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = stored(keyed.withColumn("other", other).select("band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "digest"))
    drop_stored(pairs, shared)
    return met


def shared_buckets(keyed: DataFrame, block: int) -> DataFrame:
    """(band, digest, blocks), stored: the members of every bucket with two or more of them, from distinct rows (digest, band, size in bytes).

    Of buckets with the same members one is kept. A bucket with more than `block` members, or more than BLOCK_BYTES of them, is to be cut
    into so many blocks; two of them are one task's work.
    """
    pairs = keyed = stored(keyed)
    mixed = F.xxhash64("digest")
    sets = keyed.groupBy("band").agg(
        F.count(F.lit(1)).alias("count"), F.sum("size").alias("bytes"), F.bit_xor(mixed).alias("xor"), F.bit_xor(F.xxhash64(mixed, "digest")).alias("other")
    )
    least = F.struct("band", "bytes")
    shared = sets.filter("count > 1").groupBy("count", "xor", "other").agg(F.min(least).alias("least")).select("count", "least.*")
    blocks = F.least("count", F.greatest(F.ceil(2 * F.col("count") / block), F.ceil(2 * F.col("bytes") / BLOCK_BYTES))).cast("int")
    blocks = F.when((F.col("count") > block) | (F.col("bytes") > BLOCK_BYTES), blocks).otherwise(1)
    met = stored(keyed.join(shared.select("band", blocks.alias("blocks")), "band").select("band", "digest", "blocks"))
    spent(pairs)
    return met


def compared(met: DataFrame, members: DataFrame, verify: Callable[[list[tuple[int, bytes, int]]], list[tuple[int, int]]]) -> DataFrame:
    """Links (a, b) of digests, stored, that connect all similar members (digest, shingles) of a bucket of `shared_buckets`.

    `verify` gets members (digest, shingles, label) and returns links that connect the similar ones whose labels differ. A bucket of one block
    is one task's work. Others are dealt out by two hashes, each member to two blocks, which connects a large group of copies at a cost in
    proportion to its size. Then only pairs that are not connected yet are left: the members outside the largest connected part of the
    bucket meet all others, block by block; pairs inside that part never meet again.
    """
    twice = F.array(F.pmod(F.xxhash64("digest"), "blocks"), F.col("blocks") + F.pmod(F.xxhash64("digest", F.lit(1)), "blocks"))
    place = F.explode(F.when(F.col("blocks") > 1, twice).otherwise(F.array(F.lit(0).cast("long"))))
    first = met.select("band", "digest", F.col("digest").alias("label"), place.alias("x")).withColumn("y", F.col("x"))
    links = stored(_verified(first, members, verify))
    crowded = met.filter("blocks > 1")
    if crowded.isEmpty():
        return links
    roots = components(links)
    labelled = crowded.join(roots, F.col("digest") == F.col("node"), "left").select("band", "digest", "blocks", F.coalesce("root", "digest").alias("label"))
    labelled = stored(labelled)
    parts = labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("count"))
    parts = parts.groupBy("band").agg(F.max(F.struct("count", "label")).alias("most"), F.sum("count").alias("all")).filter("most.count < all")
    outside = (F.col("all") - F.col("most.count")) / F.col("all")
    parts = parts.select("band", F.col("most.label").alias("main"), outside.alias("outside"))
    rest = labelled.join(parts, "band").withColumn("is_outside", F.col("label") != F.col("main"))
    # Blocks 0 ... own - 1 hold the members outside the largest part, the next ones that part.
    rest = rest.withColumn("own", F.ceil(F.col("blocks") * F.col("outside"))).withColumn("others", F.ceil(F.col("blocks") * (1 - F.col("outside"))))
    mixed = F.xxhash64("digest")
    block = F.when(F.col("is_outside"), F.pmod(mixed, "own")).otherwise(F.col("own") + F.pmod(mixed, "others"))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("is_outside"), F.col("own") + F.col("others")).otherwise(F.col("own")) - 1))
    rest = rest.withColumn("block", block).withColumn("other", meets)
    rest = rest.select("band", "digest", "label", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    every = stored(links.unionByName(_verified(rest, members, verify)).distinct())
    spent(links, labelled, roots)
    return every


def _verified(met: DataFrame, members: DataFrame, verify: Callable[[list[tuple[int, bytes, int]]], list[tuple[int, int]]]) -> DataFrame:
    """Links of the members (band, digest, label, x, y) that meet in one task each (band, x, y)."""
    grouped = met.join(members, "digest").repartition("band", "x", "y").sortWithinPartitions("band", "x", "y", "digest")
    grouped = grouped.select("band", "x", "y", "digest", "shingles", "label")

    def run(batches):
        key, together = None, []
        for batch in batches:
            links = []
            for band, x, y, *member in zip(*[column.to_pylist() for column in batch.columns]):
                if (band, x, y) != key:
                    links += verify(together)
                    key, together = (band, x, y), []
                together.append(tuple(member))
            yield _batch(links)
        yield _batch(verify(together))

    return grouped.mapInArrow(run, "a long, b long").distinct()


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
