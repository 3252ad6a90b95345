"""Hard negatives by a multiway hyperplane tree (GNAT): for every anchor and positive the best other-label rows below it.

Split points come from a bounded sample; every row is placed by its nearest split point on each level, and each split
point stores the smallest and largest distance to the rows of its siblings' subtrees, taken over all rows.  A search
turns its window of scores into an annulus around the anchor, drops siblings whose ranges the annulus cannot meet, and
compares the rest exactly: blocks of anchors against blocks of rows, one product of matrices each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.llm.common import Shared, drop_stored, stored
from curbflow.llm.vectors import MATRIX_BYTES, STEPS, common_dimensions, decoded, dimensions, matrices, whole_vectors

# Rows that fit the split points and the first bounds (fewer if vectors are so long that they would exceed MATRIX_BYTES).
SAMPLE_ROWS = 4096
# Children of a split, and levels of splits.
FANOUT, LEVELS = 8, 2
# Rows and anchors that meet in one product of matrices.
BLOCK_ROWS, PACK_ROWS = 1024, 256
# Whole numbers below this are exact as doubles, in any order of addition.
EXACT = float(1 << 53)

BLOCK = "leaf int, keys binary, nulls binary, labels binary, x binary, low array<double>, high array<double>"
PACK = "leaf int, q binary, keys binary, nulls binary, labels binary, x binary, low binary, high binary"
HITS = "q long, place int, score long, key long"


def hard_negatives(
    embeddings: DataFrame,
    *,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    steps: int = STEPS,
) -> DataFrame:
    """Per anchor and positive up to `negatives` rows: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component is floor(steps * component); a score is the inner product of such vectors, higher first, then the smaller
    key (NULL last).  Positives of an anchor are the first rows of its label, negatives the first rows of other labels with
    low * positive <= 100 * score <= high * positive.  The result is exact: the tree only spares work.

    Rows with a NULL label or an unusable vector (NULL, empty, NULL or non-finite component, another length than most) take
    no part.  Rows equal in key, label and vector are one row; rows that share a key but differ otherwise are different rows.  A NULL key can
    be a positive or negative, and an anchor where `anchors` says so; NULL there is no.  Numbers beyond the square root of 2**62 / dimensions are cut
    to it, so that a score fits in a long.  Other columns are ignored; an empty table gives no rows.
    """
    keep = {"key": F.col(key).cast("long"), "label": F.col(label).cast("long"), "anchor": F.coalesce(anchors, F.lit(False))}
    whole = whole_vectors(embeddings.filter(F.col(label).isNotNull()), vector, keep, steps)
    rows = stored(whole.groupBy("key", "label", "x").agg(F.max("anchor").alias("anchor")))
    size = common_dimensions(rows)
    rows = rows.filter(dimensions() == size)
    tree = _planted(rows, size)
    blocks, queries = _indexed(rows, tree), _numbered(rows)
    near = _search(queries, blocks, tree, positives, same=True)
    found = stored(near.select("q", F.col("place").alias("rank"), F.col("key").alias("positive"), F.col("score").alias("positive_score")))
    least, most = _percent("positive_score", *percent)
    open_ = found.withColumns({"low": least, "high": most}).filter("low <= high")
    windows = open_.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("rank")))
    both = F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("windows")
    asked = queries.drop("low", "high").join(windows.groupBy("q").agg(both), "q")
    asked = stored(asked.select("q", "key", "label", "x", F.col("windows.low").alias("low"), F.col("windows.high").alias("high")))
    far = _search(asked, blocks, tree, negatives, same=False, windows=positives)
    pairs = far.withColumnsRenamed({"place": "rank", "key": "negative", "score": "negative_score", "window": "place"})
    named = windows.select("q", "place", "positive", "positive_score").join(queries.select("q", F.col("key").alias("anchor_key")), "q")
    result = stored(
        pairs.join(named, ["q", "place"]).select(
            F.col("anchor_key").alias("anchor_id"),
            F.col("positive").alias("positive_id"),
            "rank",
            F.col("negative").alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )
    drop_stored(rows, found, asked, queries, blocks)
    return result


def _percent(score: str, low: int, high: int) -> tuple[Column, Column]:
    """The smallest and the largest whole number between two percentages of a score, without leaving a long."""
    rest = F.pmod(F.col(score), F.lit(100))
    hundreds = F.expr(f"({score} - pmod({score}, 100)) div 100")
    return hundreds * low + F.ceil(rest * low / 100).cast("long"), hundreds * high + F.floor(rest * high / 100).cast("long")


# The tree


@dataclass
class Split:
    """Split points, the child of each (a split's place, or -1 - leaf), and what the rows below hold."""

    points: np.ndarray
    children: list[int]
    # low[i, j], high[i, j]: distances from point i to the rows below child j; empty subtrees have low above high.
    low: np.ndarray
    high: np.ndarray
    # Smallest and largest squared length of the rows below each child.
    least: np.ndarray
    most: np.ndarray


@dataclass
class Tree:
    size: int
    splits: list[Split] = field(default_factory=list)
    # By leaf: (split, child) from the root down.
    paths: list[list[tuple[int, int]]] = field(default_factory=list)
    # Sample: keys, whether they are NULL, labels, vectors.
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nulls: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    x: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))

    @property
    def cut(self) -> int:
        """Largest whole number of a component, so that scores fit in a long."""
        return int((2.0**62 / max(1, self.size)) ** 0.5)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of longs."""
    longest = [np.sqrt((m.astype(float) ** 2).sum(axis=1).max(initial=0)) for m in (a, b)]
    if longest[0] * longest[1] < EXACT:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of two matrices."""
    one, two = a.astype(float), b.astype(float)
    square = (one**2).sum(axis=1)[:, None] + (two**2).sum(axis=1) - 2 * (one @ two.T)
    return np.sqrt(np.maximum(square, 0.0))


def grown(x: np.ndarray, size: int, fanout: int = FANOUT, levels: int = LEVELS) -> Tree:
    """A tree over the rows of a sample, without ranges: split points far from each other, rows to the nearest."""
    tree = Tree(size)
    # (rows, level, path, split and child that lead here)
    waiting = [(np.arange(len(x)), 0, [], None)]
    while waiting:
        rows, level, path, parent = waiting.pop(0)
        points = _far_apart(x[rows], fanout) if level < levels else []
        if len(points) < 2:
            place = -1 - len(tree.paths)
            tree.paths.append(path)
        else:
            place, m = len(tree.splits), len(points)
            split = Split(x[rows[points]], [0] * m, np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full(m, np.inf), np.full(m, -np.inf))
            tree.splits.append(split)
            nearest = distances(x[rows], split.points).argmin(axis=1)
            waiting += [(rows[nearest == j], level + 1, [*path, (place, j)], (place, j)) for j in range(m)]
        if parent is not None:
            tree.splits[parent[0]].children[parent[1]] = place
    return tree


def _far_apart(x: np.ndarray, count: int) -> list[int]:
    """Places of up to `count` different rows, each the farthest from those before it; the first is the farthest from the mean."""
    if not len(x):
        return []
    chosen = [int(distances(x, x.mean(axis=0)[None, :])[:, 0].argmax())]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < count and near.max() > 0.5:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return chosen


def _planted(rows: DataFrame, size: int) -> Tree:
    """The tree over the rows with the smallest hashes."""
    most = max(1, min(SAMPLE_ROWS, MATRIX_BYTES // (8 * max(1, size))))
    sample = rows.orderBy(F.xxhash64("key", "label", "x"), "key", "label", "x").limit(most).select("key", "label", "x").collect()
    cut = Tree(size).cut
    x = np.clip(decoded([bytes(r["x"]) for r in sample], size), -cut, cut)
    tree = grown(x, size)
    tree.keys = np.array([r["key"] or 0 for r in sample], np.int64)
    tree.nulls = np.array([r["key"] is None for r in sample], bool)
    tree.labels = np.array([r["label"] for r in sample], np.int64)
    tree.x = x
    return tree


def leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of every row: from split to split to the nearest point."""
    out, waiting = np.zeros(len(x), np.int32), [(0 if tree.splits else -1, np.arange(len(x)))]
    while waiting:
        place, rows = waiting.pop()
        if place < 0:
            out[rows] = -1 - place
            continue
        nearest = distances(x[rows], tree.splits[place].points).argmin(axis=1)
        waiting += [(child, rows[nearest == j]) for j, child in enumerate(tree.splits[place].children) if (nearest == j).any()]
    return out


# The index


def _indexed(rows: DataFrame, tree: Tree) -> DataFrame:
    """All rows as stored blocks of their leaves; fills in the tree's ranges."""
    shared, size, cut = Shared(rows.sparkSession, tree), tree.size, tree.cut

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, size):
            own = pa.array(leaves(shared.value, np.clip(x, -cut, cut)), pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns, own], [*part.schema.names, "leaf"])

    placed = stored(rows.select("key", "label", "x").mapInArrow(place, "key long, label long, x binary, leaf int"))
    # A leaf that holds many rows, however alike, is dealt over as many blocks as it needs.
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts"))
    dealt = placed.join(F.broadcast(sizes), "leaf")  # one row a leaf: FANOUT ** LEVELS at most
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key", "label", "x"), F.col("parts"))).drop("parts")

    def pack(table: pa.Table) -> pa.Table:
        x = np.clip(decoded(table.column("x"), size), -cut, cut)
        leaf = table.column("leaf")[0].as_py()
        low, high = [], []
        for at, _ in shared.value.paths[leaf]:
            far = distances(x, shared.value.splits[at].points)
            low, high = [*low, *far.min(axis=0)], [*high, *far.max(axis=0)]
        square = (x.astype(float) ** 2).sum(axis=1)
        return pa.table(
            {
                "leaf": pa.array([leaf], pa.int32()),
                **_packed_keys(table),
                "x": [_narrow(x)],
                "low": pa.array([[*low, square.min()]], pa.list_(pa.float64())),
                "high": pa.array([[*high, square.max()]], pa.list_(pa.float64())),
            }
        )

    blocks = stored(dealt.groupBy("leaf", "block").applyInArrow(pack, BLOCK))
    drop_stored(placed)
    pairs = blocks.select("leaf", F.posexplode(F.arrays_zip("low", "high")).alias("place", "ends"))
    ends = pairs.groupBy("leaf", "place").agg(F.min("ends.low").alias("low"), F.max("ends.high").alias("high")).collect()
    _fill(tree, {(r["leaf"], r["place"]): (r["low"], r["high"]) for r in ends})
    return blocks


def _fill(tree: Tree, ends: dict[tuple[int, int], tuple[float, float]]) -> None:
    """Ranges of every split from those of its leaves, whose places follow the path from the root and end with the squared length."""
    for leaf, path in enumerate(tree.paths):
        at = 0
        last = sum(len(tree.splits[place].points) for place, _ in path)
        for place, j in path:
            split = tree.splits[place]
            for i in range(len(split.points)):
                low, high = ends.get((leaf, at + i), (np.inf, -np.inf))
                split.low[i, j], split.high[i, j] = min(split.low[i, j], low), max(split.high[i, j], high)
            low, high = ends.get((leaf, last), (np.inf, -np.inf))
            split.least[j], split.most[j] = min(split.least[j], low), max(split.most[j], high)
            at += len(split.points)


def _packed_keys(table) -> dict[str, list[bytes]]:
    keys, labels = table.column("key"), table.column("label")
    nulls = np.asarray(keys.is_null()).astype(np.uint8)
    return {
        "keys": [np.asarray(keys.fill_null(0)).astype("<i8").tobytes()],
        "nulls": [nulls.tobytes()],
        "labels": [np.asarray(labels).astype("<i8").tobytes()],
    }


def _narrow(x: np.ndarray) -> bytes:
    """The matrix in the fewest bytes a number, which come first."""
    low, high = x.min(initial=0), x.max(initial=0)
    w = next((w for w in (1, 2, 4) if low >= -(1 << 8 * w - 1) and high < 1 << 8 * w - 1), 8)
    return bytes([w]) + x.astype(f"<i{w}").tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(-1, size).astype(np.int64)


# The search


def _numbered(rows: DataFrame) -> DataFrame:
    """The anchors with a number each."""
    numbered = rows.filter("anchor").select(F.monotonically_increasing_id().alias("q"), "key", "label", "x")
    unbounded = {"low": F.array(F.lit(-(2**63) + 1).cast("long")), "high": F.array(F.lit(2**63 - 1).cast("long"))}
    return stored(numbered.withColumns(unbounded))


def _search(queries: DataFrame, blocks: DataFrame, tree: Tree, most: int, *, same: bool, windows: int = 1) -> DataFrame:
    """Per query and window of scores its first `most` rows of the same label or of others: q, window, place, score, key."""
    shared, size = Shared(queries.sparkSession, tree), tree.size

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, size):
            own = shared.value
            yield from _routed(own, part, np.clip(x, -own.cut, own.cut), most, same, windows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_hits(row, size, most, same, windows) for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist()]
            if not found:
                continue
            q, window, score, keys, nulls = (np.concatenate(c) for c in zip(*found))
            kept = _first(q, window, score, keys, nulls, most)
            columns = [q[kept], window[kept].astype(np.int32), score[kept], pa.array(keys[kept], mask=nulls[kept])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "place", "score", "key"])

    packs = queries.hint("rebalance").mapInArrow(route, PACK)
    own = blocks.select("leaf", *[F.col(c).alias(f"b_{c}") for c in ("keys", "nulls", "labels", "x")])
    hits = packs.join(own, "leaf").mapInArrow(compare, HITS).withColumnRenamed("place", "window")
    order = Window.partitionBy("q", "window").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return ranked.select("q", "window", "place", "score", "key")


def _windows(part: pa.RecordBatch, name: str, windows: int, empty: int) -> np.ndarray:
    """The bounds of each row's windows; those that a row lacks are empty."""
    lists = part.column(name)
    out = np.full((part.num_rows, windows), empty, np.int64)
    for k, values in enumerate(lists.to_pylist()):
        out[k, : len(values)] = values
    return out


def _routed(tree: Tree, part: pa.RecordBatch, x: np.ndarray, most: int, same: bool, windows: int) -> Iterator[pa.RecordBatch]:
    """The rows as packs for every leaf that may hold a hit of theirs, with windows narrowed by what the sample holds."""
    low, high = _windows(part, "low", windows, 1), _windows(part, "high", windows, 0)
    keys, labels = part.column("key"), np.asarray(part.column("label"))
    known, ids = np.asarray(keys.is_valid()), np.asarray(keys.fill_null(0))
    score = products(x, tree.x)
    # A sample row with the query's key may be the query itself.
    other = (tree.labels == labels[:, None]) if same else (tree.labels != labels[:, None])
    other &= (tree.keys != ids[:, None]) | (tree.nulls == known[:, None])
    for w in range(windows):
        fitting = np.where(other & (score >= low[:, w, None]) & (score <= high[:, w, None]), score, np.iinfo(np.int64).min)
        if fitting.shape[1] >= most:
            low[:, w] = np.maximum(low[:, w], np.partition(fitting, -most, axis=1)[:, -most])
    full = low <= high
    first = np.where(full, low, np.iinfo(np.int64).max).min(axis=1).astype(float)
    last = np.where(full, high, np.iinfo(np.int64).min).max(axis=1).astype(float)
    square = (x.astype(float) ** 2).sum(axis=1)
    q = np.asarray(part.column("q"))
    for leaf, rows in _reached(tree, x, square, first, last, np.flatnonzero(full.any(axis=1))):
        for start in range(0, len(rows), PACK_ROWS):
            own = rows[start : start + PACK_ROWS]
            data = [q[own], ids[own], (~known[own]).astype(np.uint8), labels[own]]
            row = [pa.array([leaf], pa.int32()), *[pa.array([d.tobytes()]) for d in data], pa.array([_narrow(x[own])])]
            row += [pa.array([low[own].tobytes()]), pa.array([high[own].tobytes()])]
            yield pa.RecordBatch.from_arrays(row, ["leaf", "q", "keys", "nulls", "labels", "x", "low", "high"])


def _reached(tree: Tree, x: np.ndarray, square: np.ndarray, first: np.ndarray, last: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves with the queries that may have a row there with a score between `first` and `last`.

    With squared lengths a and b, a score s means a squared distance a + b - 2 * s: a window of scores is an annulus.
    A sibling stays only if its range from every split point meets the annulus, seen from there.
    """
    waiting = [(0 if tree.splits else -1, rows)]
    while waiting:
        place, rows = waiting.pop()
        if not len(rows):
            continue
        if place < 0:
            yield -1 - place, rows
            continue
        split = tree.splits[place]
        far = distances(x[rows], split.points)
        for j, child in enumerate(split.children):
            if split.least[j] > split.most[j]:
                continue
            spare = 1e-9 * (square[rows] + split.most[j]) + 1e-6
            outer = square[rows] + split.most[j] - 2 * first[rows] + spare
            inner = np.sqrt(np.maximum(square[rows] + split.least[j] - 2 * last[rows] - spare, 0.0))
            reach, slack = np.sqrt(np.maximum(outer, 0.0)), np.sqrt(spare)
            meets = (split.low[:, j] <= far + (reach + slack)[:, None]) & (split.high[:, j] >= far - (reach + slack)[:, None])
            meets &= far + split.high[:, j] >= (inner - slack)[:, None]
            waiting.append((child, rows[meets.all(axis=1) & (outer >= 0)]))


def _hits(row: dict, size: int, most: int, same: bool, windows: int) -> tuple[np.ndarray, ...]:
    """Of one pack and one block: the first rows of every query and window."""
    long, flag = (lambda name: np.frombuffer(row[name], np.int64)), (lambda name: np.frombuffer(row[name], np.uint8).astype(bool))
    q, x, b = long("q"), _wide(row["x"], size), _wide(row["b_x"], size)
    keys, nulls, b_keys, b_nulls = long("keys"), flag("nulls"), long("b_keys"), flag("b_nulls")
    low, high = long("low").reshape(-1, windows), long("high").reshape(-1, windows)
    score = products(x, b)
    alike = long("labels")[:, None] == long("b_labels")
    allowed = alike if same else ~alike
    if same:
        twins = np.argwhere(allowed & (keys[:, None] == b_keys) & (nulls[:, None] == b_nulls))
        for i, k in twins:
            if (x[i] == b[k]).all():  # the query itself
                allowed[i, k] = False
    parts = []
    for w in range(windows):
        i, k = np.nonzero(allowed & (score >= low[:, w, None]) & (score <= high[:, w, None]))
        found = (q[i], np.full(len(i), w + 1), score[i, k], b_keys[k], b_nulls[k])
        kept = _first(*found, most)
        parts.append(tuple(column[kept] for column in found))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _first(q: np.ndarray, window: np.ndarray, score: np.ndarray, keys: np.ndarray, nulls: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` rows of every query and window."""
    order = np.lexsort((keys, nulls, -score, window, q))
    q, window = q[order], window[order]
    starts = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (window[1:] != window[:-1])])) if len(q) else np.zeros(0, int)
    place = np.arange(len(q)) - np.repeat(starts, np.diff([*starts, len(q)]))
    return order[place < most]
