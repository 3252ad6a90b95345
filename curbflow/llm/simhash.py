"""Operator 6: SimHash near-duplicates by a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import lower_words, map_slices, spent, stored, texts
from curbflow.llm.components import components

# Fingerprints of a node pair that one task compares at most; larger pairs descend further down the trie first.
NODE_LIMIT = 2048
# Levels by which a node pair that is too large descends at once.
LEVELS = 3
# Pairs within the budget that are held at once.
PAIRS = 1 << 20


def fingerprints(docs: DataFrame, width: int = 3, bits: int = 64, seed: int = 42) -> DataFrame:
    """The rows with `high` and, for 128 bits, `low` (long): the SimHash of each text.

    Words are white-space separated with A-Z lower-cased; shingles are `width` words joined by one space, repeats
    included; a text of fewer words has its whole sequence as the only shingle, NULL and empty texts have fingerprint 0.
    64 bits take XXH64 with the seed, 128 bits XXH3-128. A bit is 1 if it is set in over half the shingles. Only doc_id
    and the text's own hash (`text_hash`) are kept beside the fingerprint.
    """
    size = bits // 8

    def shingle_hash(shingle: bytes) -> bytes:
        return xxhash.xxh64_digest(shingle, seed) if bits == 64 else xxhash.xxh3_128_digest(shingle, seed)

    def run(batch: pa.RecordBatch) -> dict:
        prints = np.array([simhash(lower_words(t), width, shingle_hash, size) for t in texts(batch)], dtype=np.uint64)
        prints = prints.reshape(batch.num_rows, size // 8).view(np.int64)
        low = prints[:, 1] if bits == 128 else np.zeros(batch.num_rows, dtype=np.int64)
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "high": prints[:, 0], "low": low}

    kept = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return map_slices(kept, run, "doc_id long, text_hash long, high long, low long")


def simhash(words: list[bytes], width: int, shingle_hash, size: int) -> list[int]:
    """The fingerprint of one word list as unsigned 64-bit numbers."""
    if not words:
        return [0] * (size // 8)
    return majority(shingle_digests(words, width, shingle_hash, size))


def shingle_digests(words: list[bytes], width: int, shingle_hash, size: int) -> np.ndarray:
    """The hash of every shingle as a row of unsigned 64-bit numbers, repeats included."""
    text = b" ".join(words)
    count = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    last = ends[-count:].tolist()
    first = [0, *(ends[: count - 1] + 1).tolist()]
    hashes = np.frombuffer(b"".join([shingle_hash(text[i:j]) for i, j in zip(first, last)]), dtype=">u8")
    return hashes.reshape(count, size // 8).astype(np.uint64)


def majority(hashes: np.ndarray) -> list[int]:
    """Numbers whose bits are those that are set in over half the rows."""
    count = len(hashes)
    lanes = np.uint64(0x0101010101010101)
    blocks = np.arange(0, count, 255)
    out = []
    for k in range(hashes.shape[1]):
        column, bits = hashes[:, k], 0
        for shift in range(8):
            # Eight bit counters in the bytes of one word: no carry within 255 rows.
            sums = np.add.reduceat((column >> np.uint64(shift)) & lanes, blocks).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
            for byte in range(8):
                if 2 * int(sums[byte]) > count:
                    bits |= 1 << (8 * byte + shift)
        out.append(bits)
    return out


def hamming_links(prints: DataFrame, budget: int = 2, segments: int = 3, total: int | None = None) -> DataFrame:
    """Links (high, low, other_high, other_low) that connect all fingerprints within the error budget.

    A trie over the bits of `high` is joined with itself: node pairs descend together, differing bits add up, and a pair
    over the budget is pruned. The bits are turned so that each of the segments comes first once: two fingerprints within
    the budget differ in at most budget // segments bits of one segment, so only node pairs within that many errors
    exist below it. Those pairs are the shuffle key; a pair with more than NODE_LIMIT fingerprints is split by
    descending LEVELS more levels, as often as needed. Within a task the descent goes on on sorted numbers. Each task returns a spanning forest
    of its links, which keeps every connection without writing all pairs. `total` also limits the differing bits of high and low together.

    Large node pairs are linked in blocks first, at a cost in proportion to their fingerprints: what is connected then need not meet again. Node pairs
    in which all is connected, or of which one node is empty, are left out, so a large group of near copies isn't copied along every path.
    """
    distinct = stored(prints.select("high", "low").distinct())
    nodes = _first_nodes(distinct, budget, segments)
    key = ["turn", "depth", "node", "mask"]
    columns = ["turn", "depth", "node", "mask", "block", "bits", "low"]
    # A pair of two nodes is large only if one of them alone has half as many.
    large = stored(nodes.filter("mask = 0").groupBy(*key).count().filter(F.col("count") > NODE_LIMIT // 2))

    def linked(nodes: DataFrame) -> DataFrame:
        grouped = nodes.select(*columns).repartition(*columns[:5]).sortWithinPartitions(*columns[:6])
        return grouped.mapInArrow(_pair_runner(budget, total), "high long, low long, other_high long, other_low long")

    if large.isEmpty():
        spent(large)
        return linked(nodes.withColumn("block", F.lit(0).cast("long")))
    blocks = F.ceil(2 * F.col("count") / NODE_LIMIT)
    twice = F.array(F.pmod(F.xxhash64("bits", "low"), blocks), blocks + F.pmod(F.xxhash64("bits", "low", F.lit(1)), blocks))
    links = stored(linked(nodes.join(large, key).withColumn("block", F.explode(twice))))
    roots = components(links.select(F.struct("high", "low").alias("a"), F.struct(F.col("other_high").alias("high"), F.col("other_low").alias("low")).alias("b")))
    roots = roots.select("node.*", F.col("root.high").alias("root_high"), F.col("root.low").alias("root_low"))
    labels = [F.coalesce("root_high", "high").alias("root_high"), F.coalesce("root_low", "low").alias("root_low")]
    nodes = _first_nodes(stored(distinct.join(roots, ["high", "low"], "left").select("high", "low", *labels)), budget, segments)
    spent(large, roots)
    done = []
    limited = (F.col("count") > NODE_LIMIT) & (F.col("depth") <= 64 - LEVELS)
    side = F.expr("shiftrightunsigned(bits, 64 - depth) = node")
    several = [F.min(c) != F.max(c) for c in ("root_high", "root_low")]
    while True:
        groups = nodes.groupBy(*key).agg(F.count(F.lit(1)).alias("count"), (several[0] | several[1]).alias("apart"), (F.min(side) != F.max(side)).alias("both"))
        groups = stored(groups.filter("apart and (mask = 0 or both)").select(*key, limited.alias("large")))
        done.append(nodes.join(groups.filter("not large"), key, "left_semi"))
        large = groups.filter("large")
        if large.isEmpty():
            break
        nodes = stored(_descend(nodes.join(large, key, "left_semi"), F.col("depth"), LEVELS, budget))
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    return links.unionByName(linked(done[0].withColumn("block", F.lit(0).cast("long"))))


def _first_nodes(prints: DataFrame, budget: int, segments: int) -> DataFrame:
    """turn, depth, node, mask, bits, low, and columns of prints but high: the node pairs of every turn below its first segment."""
    edges = [64 * k // segments for k in range(segments + 1)]
    nodes = None
    for start, end in zip(edges, edges[1:]):
        turned = F.shiftleft("high", start).bitwiseOR(F.shiftrightunsigned("high", 64 - start)) if start else F.col("high")
        part = prints.withColumn("turn", F.lit(start)).withColumn("bits", turned).drop("high")
        part = _descend(part.withColumn("mask", F.lit(0).cast("long")), 0, end - start, budget // segments)
        nodes = part if nodes is None else nodes.unionByName(part)
    return nodes


def _descend(nodes: DataFrame, depth, levels: int, budget: int) -> DataFrame:
    """Node pairs `levels` further down: the pair's differing bits so far (mask) plus those of the new levels."""
    steps = [m for m in range(1 << levels) if m.bit_count() <= budget] if levels <= LEVELS else _masks(levels, budget)
    deeper = nodes.withColumn("step", F.explode(F.array(*[F.lit(m).cast("long") for m in steps])))
    deeper = deeper.withColumn("mask", F.shiftleft("mask", levels).bitwiseOR(F.col("step")))
    deeper = deeper.filter(F.bit_count("mask") <= budget)
    new_depth = (F.lit(depth) if isinstance(depth, int) else depth) + levels
    prefix = F.expr("shiftrightunsigned(bits, 64 - new_depth)")
    deeper = deeper.withColumn("new_depth", new_depth.cast("int"))
    labels = [c for c in ("root_high", "root_low") if c in nodes.columns]
    return deeper.select(
        "turn", F.col("new_depth").alias("depth"), F.least(prefix, prefix.bitwiseXOR(F.col("mask"))).alias("node"), "mask", "bits", "low", *labels
    )


def _masks(width: int, budget: int) -> list[int]:
    """All numbers of the width with at most `budget` bits."""
    masks = {0}
    for _ in range(budget):
        masks |= {m | (1 << k) for m in masks for k in range(width)}
    return sorted(masks)


def _pair_runner(budget: int, total: int | None):
    def run(batches):
        rest = None
        for batch in batches:
            table = {n: batch.column(n).to_numpy() for n in ("turn", "depth", "node", "mask", "block", "bits", "low")}
            if rest is not None:
                table = {n: np.concatenate([rest[n], v]) for n, v in table.items()}
            change = np.zeros(len(table["node"]), dtype=bool)
            change[1:] = False
            for n in ("turn", "depth", "node", "mask", "block"):
                change[1:] |= table[n][1:] != table[n][:-1]
            starts = np.concatenate([[0], np.flatnonzero(change)]) if len(change) else np.zeros(1, dtype=np.int64)
            rest = {n: v[starts[-1] :] for n, v in table.items()}
            yield from _groups(table, starts, budget, total)
        if rest is not None and len(rest["node"]):
            yield from _groups(rest, np.array([0, len(rest["node"])]), budget, total)

    return run


def _groups(table: dict, starts: np.ndarray, budget: int, total: int | None):
    """Links of the complete groups that begin at starts[:-1]."""
    found = []
    for k in np.flatnonzero(np.diff(starts) > 1).tolist():
        lo, hi = int(starts[k]), int(starts[k + 1])
        own = {n: v[lo:hi] for n, v in table.items()}
        bits, low = own["bits"].view(np.uint64), own["low"].view(np.uint64)
        root = np.arange(len(bits))
        for i, j in trie_pairs(bits, int(own["depth"][0]), int(own["mask"][0]), budget):
            if total is not None:
                close = np.bitwise_count(bits[i] ^ bits[j]).astype(int) + np.bitwise_count(low[i] ^ low[j]) <= total
                i, j = i[close], j[close]
            root = forest(root, i, j)
        linked = np.flatnonzero(root != np.arange(len(bits)))
        if len(linked):
            turn = np.uint64(own["turn"][0])
            back = ((bits >> turn) | (bits << (np.uint64(64) - turn))) if turn else bits
            found.append((back[linked], low[linked], back[root[linked]], low[root[linked]]))
    if found:
        arrays = [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*found)]
        yield pa.RecordBatch.from_arrays(arrays, names=["high", "low", "other_high", "other_low"])


def trie_pairs(bits: np.ndarray, depth: int, mask: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions whose sorted numbers are within the budget and whose top `depth` bits differ by the mask, about PAIRS at a time."""
    top = bits >> np.uint64(64 - depth)
    first = int(np.searchsorted(top, top[0], side="right"))
    stack = [(0, first, 0, first, depth, 0)] if mask == 0 else [(0, first, first, len(bits), depth, mask.bit_count())]
    left, right, held = [], [], 0
    while stack:
        a, b, c, d, at, errors = stack.pop()
        if errors > budget or a == b or c == d:
            continue
        if (b - a) * (d - c) <= 4096 or at == 64:
            step = min(512, max(1, PAIRS // (d - c)))
            for rows in range(a, b, step):
                upper = min(b, rows + step)
                near = np.bitwise_count(bits[rows:upper, None] ^ bits[None, c:d]) <= budget
                i, j = np.nonzero(near)
                i, j = i + rows, j + c
                left.append(i[i < j])
                right.append(j[i < j])
                held += len(left[-1])
                if held >= PAIRS:
                    yield np.concatenate(left), np.concatenate(right)
                    left, right, held = [], [], 0
            continue
        one = np.uint64(1 << (63 - at))
        m = a + int(np.searchsorted((bits[a:b] & one) != 0, True))
        n = c + int(np.searchsorted((bits[c:d] & one) != 0, True))
        stack += [(a, m, c, n, at + 1, errors), (m, b, n, d, at + 1, errors), (a, m, n, d, at + 1, errors + 1)]
        if a != c:
            stack.append((m, b, c, n, at + 1, errors + 1))
    if held:
        yield np.concatenate(left), np.concatenate(right)


def forest(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position connected with each position, of those before (`label`) and more pairs."""
    i, j = label[i], label[j]
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 64, budget: int = 2, segments: int = 3, total: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, fingerprint (hex), component_id.

    component_id is the smallest doc_id reachable over links of at most `budget` differing bits (and `total` of 128),
    the document itself included; a NULL id is NULL unless its component has another. Equal fingerprints are one node:
    copies are never expanded into pairs. Repeated rows get the same result each; an empty table gives an empty one;
    columns beside doc_id and text are not read.
    """
    digits = F.lower(F.lpad(F.hex("high"), 16, "0"))
    if bits == 128:
        digits = F.concat(digits, F.lower(F.lpad(F.hex("low"), 16, "0")))
    prints = stored(fingerprints(docs, width, bits).withColumn("fingerprint", digits))
    links = hamming_links(prints, budget, segments, total)
    other = F.lower(F.lpad(F.hex("other_high"), 16, "0"))
    if bits == 128:
        other = F.concat(other, F.lower(F.lpad(F.hex("other_low"), 16, "0")))
    roots = components(links.select(digits.alias("a"), other.alias("b")))
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    nodes = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fingerprint"))
    nodes = stored(nodes.select("fingerprint", "root", "first"))
    ids = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = nodes.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")
