"""Operator 8: hidden Markov language model, trained by Baum-Welch counts added up over partitions."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import Shared, map_slices, slices, stored

# Words with a symbol of their own at most: the most frequent ones. All others share one of TAIL symbols by their ending,
# and a word's own frequency decides within the symbol.
HEAD_WORDS = 16384
TAIL = 1024
STATES = 8
# Passes of Baum-Welch, each over all training texts.
PASSES = 15
# Training texts are cut into chains of this many tokens; scoring runs over the whole text.
CHAIN = 128
# Chains whose states are held at a time, whatever a text's length.
GROUP = 4096
# Steps after which the counts' forward probabilities are scaled: a step shrinks them by the least transition at most, some 1e-10.
SCALED = 16
# Rare words that one task of the counting meets, about.
BUCKET_WORDS = 3_000_000
_SLICE = 4 << 20


def head_words(docs: DataFrame, limit: int = HEAD_WORDS) -> list[bytes]:
    """The most frequent words, at most `limit`, by counts in slices of the texts.

    A slice reports the words that make up more than 1 / (4 * limit) of its tokens, so a word that isn't reported anywhere makes up no
    more than that share of all tokens. Only words with more than that share of all tokens come to the driver, 4 * limit at
    most however many tasks there are. The choice bounds the load of a word, not the result: any choice gives right counts.
    """

    def run(batch: pa.RecordBatch) -> dict:
        words, _ = split_words(lowered(batch.column("text")))
        counted, total = words.value_counts(), len(words)
        words, counts = counted.field("values"), counted.field("counts").to_numpy()
        often = counts > total / (4 * limit)
        # Without a word: all tokens of the slice.
        return {"word": [None, *words.filter(pa.array(often)).to_pylist()], "n": [total, *counts[often].tolist()]}

    counted = map_slices(docs.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted)
    total = counted.filter("word is null").agg(F.sum("n")).first()[0] or 0
    frequent = counted.filter(F.col("word").isNotNull() & (4 * limit * F.col("n") > total))
    return [bytes(r["word"]) for r in frequent.orderBy(F.desc("n"), "word").limit(limit).collect()]


def symbols(docs: DataFrame, head: list[bytes]) -> DataFrame:
    """uid, doc_id, held_out, n_tokens, ids (little-endian 16-bit symbols), tail (the words without a symbol), n_tail."""
    shared = Shared(docs.sparkSession, head)

    def run(batch: pa.RecordBatch) -> dict:
        known = pa.array(shared.value, pa.binary())
        end, first = len(known), len(known) + 1
        words, sizes = split_words(lowered(batch.column("text")))
        coded = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
        rare = coded < 0
        tail = words.filter(pa.array(rare))
        coded = coded.astype("<u2")
        coded[rare] = first + tail_classes(tail)
        # Places of the words, and of an end after each text's.
        edges = np.concatenate([[0], np.cumsum(sizes + 1)])
        ids, word = np.full(edges[-1], end, dtype="<u2"), np.ones(edges[-1], dtype=bool)
        word[edges[1:] - 1] = False
        ids[word] = coded
        before = np.concatenate([[0], np.cumsum(rare)])[np.concatenate([[0], np.cumsum(sizes)])]
        out = {n: batch.column(n) for n in ("uid", "doc_id", "held_out")}
        return out | {
            "n_tokens": sizes + 1,
            "ids": pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((2 * edges).astype(np.int32)), pa.py_buffer(ids)]),
            "tail": pc.binary_join(pa.ListArray.from_arrays(pa.array(before, pa.int32()), tail), b" "),
            "n_tail": np.diff(before),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", "text")
    return map_slices(kept, run, f"uid long, doc_id {kind}, held_out boolean, n_tokens long, ids binary, tail binary, n_tail long")


def tail_class(word: bytes) -> int:
    """The shared symbol of a word without its own: by its last bytes."""
    return zlib.crc32(word[-4:]) % TAIL


def tail_classes(words: pa.Array) -> np.ndarray:
    """`tail_class` of every word, worked out once per ending."""
    endings = pc.binary_slice(words, -4).dictionary_encode()
    return np.array([tail_class(w) for w in endings.dictionary.to_pylist()], dtype=np.int64)[endings.indices.to_numpy()]


def lowered(column: pa.Array) -> pa.Array:
    """The texts as bytes with A-Z lower-cased."""
    return pc.ascii_lower(column.cast(pa.binary()).view(pa.string())).view(pa.binary())


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The white-space separated words of all rows (bytes) in order, and how many each row has; none for NULL."""
    split = pc.ascii_split_whitespace(column.view(pa.string()))
    words, sizes = split.flatten().view(pa.binary()), pc.fill_null(pc.list_value_length(split), 0).to_numpy()
    # White space at either end, or a text without any word, leaves an empty word.
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[np.concatenate([[0], np.cumsum(sizes)])])


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _full(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed_ids(ids: np.ndarray) -> bytes:
    """Numbers as compressed differences: ids of neighbouring rows take about a byte."""
    return _squeezed(np.diff(ids, prepend=0).astype(np.int64).tobytes())


def _unpacked_ids(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_full(data), np.int64))


def rare_words(coded: DataFrame, buckets: int) -> DataFrame:
    """part, keys, values, counts (packed numbers): what counting the words without a symbol gives.

    For every block of documents (part) and bucket of words: the uids, the sum of log10(c + 1) over a document's words, and how many
    have c > 0, where c is the word's count in the training texts. With part NULL: shared symbols, and their distinct words in the
    training texts. Words are dealt out by hash in compressed blocks, a block per slice and bucket, so all occurrences of
    a word meet in one bucket; frequent words are not among them.
    """

    def deal(batch: pa.RecordBatch) -> dict | None:
        words, owner = split_words(batch.column("tail"))
        if not len(words):
            return None
        coded_words = words.dictionary_encode()
        unique = coded_words.dictionary.to_pylist()
        bucket = np.array([xxhash.xxh32_intdigest(w) for w in unique], dtype=np.int64) % buckets
        rows = np.repeat(np.arange(batch.num_rows), owner)
        index = coded_words.indices.to_numpy()
        pair, count = np.unique(index.astype(np.int64) * batch.num_rows + rows, return_counts=True)
        index, rows = pair // batch.num_rows, pair % batch.num_rows
        uids = batch.column("uid").to_numpy()
        trained = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(bucket[index], kind="stable")
        edges = np.searchsorted(bucket[index][order], np.arange(buckets + 1))
        out_bucket, payload = [], []
        for b in range(buckets):
            own = order[edges[b] : edges[b + 1]]
            if len(own):
                # Pairs are in order of the words, so the words of this block are a run-length list.
                which, place = np.unique(index[own], return_inverse=True)
                docs, doc = np.unique(rows[own], return_inverse=True)
                block = (
                    int(uids[0]),
                    b" ".join([unique[k] for k in which.tolist()]),
                    place.astype(np.int32),
                    _packed_ids(uids[docs]),
                    trained[docs],
                    doc.astype(np.uint16 if len(docs) < 65536 else np.int32),
                    count[own].astype(np.int32),
                )
                out_bucket.append(b)
                payload.append(_squeezed(pickle.dumps(block, protocol=5)))
        return {"bucket": out_bucket, "payload": payload}

    def count(batches):
        now, held = None, []
        for batch in batches:
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
                if bucket != now and held:
                    yield counted_block(held)
                    held = []
                now = bucket
                held.append(payload)
        if held:
            yield counted_block(held)

    dealt = map_slices(coded.select("uid", "held_out", "tail"), deal, "bucket int, payload binary", "tail")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, "part long, keys binary, values binary, counts binary")


def counted_block(payloads: list[bytes]) -> pa.RecordBatch:
    """Counts of one bucket's words, as sums by document for each block that came in."""
    blocks = [pickle.loads(_full(p)) for p in payloads]
    words = split_words(pa.array([b[1] for b in blocks], pa.binary()))[0].dictionary_encode()
    code, at, pieces = words.indices.to_numpy(), 0, []
    for block in blocks:
        size = block[1].count(b" ") + 1
        pieces.append(code[at : at + size][block[2]])
        at += size
    total = np.zeros(len(words.dictionary))
    for piece, (_, _, _, _, trained, doc, n) in zip(pieces, blocks):
        np.add.at(total, piece, n * trained[doc])
    rows = []
    for piece, (part, _, _, uids, _, doc, n) in zip(pieces, blocks):
        own = total[piece]
        value = np.bincount(doc, weights=n * np.log10(own + 1))
        known = np.bincount(doc, weights=n * (own > 0)).astype(np.uint32)
        rows.append((part, uids, value.tobytes(), _squeezed(known.tobytes())))
    symbol, distinct = np.unique(tail_classes(words.dictionary.filter(pa.array(total > 0))), return_counts=True)
    rows.append((None, _packed_ids(symbol), b"", _squeezed(distinct.astype(np.uint32).tobytes())))
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "keys", "values", "counts"])


def tail_sums(found: DataFrame) -> DataFrame:
    """uid, tail, tail_known: the sums over all buckets, one row per document with such words."""

    def added(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([_unpacked_ids(r[0]) for r in rows])
        uids, place = np.unique(keys, return_inverse=True)
        value = np.bincount(place, weights=np.concatenate([np.frombuffer(r[1]) for r in rows]))
        known = np.bincount(place, weights=np.concatenate([np.frombuffer(_full(r[2]), np.uint32) for r in rows])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(uids), pa.array(value), pa.array(known)], names=["uid", "tail", "tail_known"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            for part, *row in zip(*[batch.column(c).to_pylist() for c in ("part", "keys", "values", "counts")]):
                if part != now and held:
                    yield added(held)
                    held = []
                now = part
                held.append(row)
        if held:
            yield added(held)

    dealt = found.filter("part is not null").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "uid long, tail double, tail_known long")


class Room:
    """Arrays by name whose memory the next call of the same name takes again: new memory for each group costs as much as its sums."""

    def __init__(self):
        self._held: dict[str, np.ndarray] = {}

    def array(self, name: str, *shape: int, kind: type = np.float64) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self._held or len(self._held[name]) < size:
            # Room for somewhat larger groups; what they don't use is never touched.
            self._held[name] = np.empty(size + size // 4, kind)
        return self._held[name][:size].reshape(shape)


@dataclass
class Chain:
    """Start, transition and emission probabilities; emission is by symbol and state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @cached_property
    def relative(self) -> np.ndarray:
        """Emissions over the symbol's largest: a factor common to all states changes no expectation, and a step shrinks little."""
        return self.emit / self.emit.max(axis=1, keepdims=True)

    def counts(self, ids: np.ndarray, lengths: np.ndarray, room: Room | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, transitions and emissions over chains of at most CHAIN symbols (forward-backward, scaled)."""
        states, number, room = len(self.start), len(lengths), room or Room()
        if not number:
            return np.zeros_like(self.start), np.zeros_like(self.move), np.zeros_like(self.emit)
        order = np.argsort(-lengths, kind="stable")
        lengths, begins = lengths[order], (np.cumsum(lengths) - lengths)[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        # Rows are in order of the place in the chain: those of place t are edges[t] to edges[t + 1], longest chains first.
        edges = np.concatenate([[0], np.cumsum(active)])
        last = edges[lengths - 1] + np.arange(number)
        edges, longest, size = edges.tolist(), len(active), int(edges[-1])
        place = room.array("place", size, kind=np.intp)
        for t in range(longest):
            np.add(begins[: edges[t + 1] - edges[t]], t, out=place[edges[t] : edges[t + 1]])
        symbol = room.array("symbol", size, kind=np.intp)
        symbol[:] = ids.take(place)
        # With a mode other than "raise", take writes to its target without a copy between.
        emit = self.relative.take(symbol, axis=0, out=room.array("emit", size, states), mode="clip")
        alpha, gamma, ones = room.array("alpha", size, states), room.array("gamma", states, size), np.ones(states)
        sizes = {}
        for t in range(longest):
            begin, end = edges[t], edges[t + 1]
            now = alpha[begin:end]
            if t:
                np.matmul(alpha[edges[t - 1] : edges[t - 1] + end - begin], self.move, out=now)
            else:
                now[:] = self.start
            now *= emit[begin:end]
            if t % SCALED == SCALED - 1:
                sizes[t] = (now @ ones)[:, None]
                now /= sizes[t]
        # Over a chain's last sum, so that alpha times beta adds up to 1 at each place.
        ends, beta = alpha[last], room.array("beta", number, states)
        beta[:] = 1 / (ends @ ones)[:, None]
        gamma[:, last] = (ends * beta).T
        moved, back = np.zeros_like(self.move), np.ascontiguousarray(self.move.T)
        for t in range(longest - 1, 0, -1):
            later = edges[t + 1] - edges[t]
            before = slice(edges[t - 1], edges[t - 1] + later)
            ahead = np.multiply(emit[edges[t] : edges[t + 1]], beta[:later], out=room.array("ahead", later, states))
            if t in sizes:
                ahead /= sizes[t]
            moved += alpha[before].T @ ahead
            np.matmul(ahead, back, out=beta[:later])
            np.multiply(alpha[before].T, beta[:later].T, out=gamma[:, before])
        emitted = [np.bincount(symbol, weights=own, minlength=len(self.emit)) for own in gamma]
        return gamma[:, :number].sum(axis=1), moved * self.move, np.stack(emitted).T

    def log10_likelihoods(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Exact log10 likelihood of each whole sequence, by the scaled forward recursion."""
        number = len(lengths)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths, begins = lengths[order], (np.cumsum(lengths) - lengths)[order]
        result = np.zeros(number)
        alpha, n, ones = np.broadcast_to(self.start, (number, len(self.start))), number, np.ones(len(self.start))
        sizes, now = sorted_lengths.tolist(), number
        for t in range(sizes[0] if number else 0):
            while sizes[now - 1] <= t:
                now -= 1
            if now < n:
                result[now:n] += np.log10(alpha[now:n] @ ones)
                alpha, n = alpha[:now], now
            emit = self.emit.take(ids.take(begins[:n] + t), axis=0)
            alpha = np.multiply(alpha @ self.move if t else alpha, emit, out=emit)
            if t % 16 == 15:
                size = alpha @ ones
                result[:n] += np.log10(size)
                alpha /= size[:, None]
        result[:n] += np.log10(alpha @ ones)
        out = np.empty(number)
        out[order] = result
        return out


def fitted(started: np.ndarray, moved: np.ndarray, emitted: np.ndarray, unigram: np.ndarray, weight: float = 50.0) -> Chain:
    """Probabilities from expected counts, smoothed towards the symbol frequencies."""
    states = len(started)
    start = (started + 1) / (started + 1).sum()
    move = (moved + 1) / (moved + 1).sum(axis=1, keepdims=True)
    emit = (emitted + weight * unigram[:, None]) / (emitted.sum(axis=0) + weight)
    return Chain(start.reshape(states), move, emit)


def chains(batch: pa.RecordBatch, cut: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the rows, and the lengths of their sequences (cut to chains)."""
    rows = batch.column("ids").to_pylist()
    ids = np.frombuffer(b"".join(rows), dtype="<u2")
    sizes = np.array([len(x) // 2 for x in rows], dtype=np.int64)
    if cut:
        sizes = sizes[sizes > 0]
        pieces = -(-sizes // cut)
        rest = sizes - (pieces - 1) * cut
        sizes = np.full(pieces.sum(), cut)
        sizes[np.cumsum(pieces) - 1] = rest
    return ids, sizes


def chain_groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The symbols and lengths of the rows' chains, GROUP chains at a time at most, about as many each time."""
    ids, lengths = chains(batch, CHAIN)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    parts = -(-len(lengths) // GROUP)
    for k in range(parts):
        begin, end = len(lengths) * k // parts, len(lengths) * (k + 1) // parts
        yield ids[edges[begin] : edges[end]], lengths[begin:end]


def baum_welch(training: DataFrame, unigram: np.ndarray, states: int = STATES, passes: int = PASSES, seed: int = 5) -> Chain:
    """The chain after `passes` over all training rows (ids) from a random start; each adds up the expected counts of all partitions by symbol."""
    spark, size = training.sparkSession, len(unigram)
    random = np.random.default_rng(seed)
    emitted = unigram[:, None] * random.uniform(0.5, 1.5, (size, states))
    chain = fitted(np.ones(states), np.eye(states) * 10.0 + 1, emitted * 1e4, unigram)
    columns = [f"s{k}" for k in range(states)]
    schema = "symbol int, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(passes):
        shared = Shared(spark, chain)

        def run(batches):
            total, room = None, Room()
            for part in slices(batches, "ids", _SLICE):
                for group in chain_groups(part):
                    found = shared.value.counts(*group, room)
                    total = found if total is None else tuple(a + b for a, b in zip(total, found))
            if total is not None:
                rows = np.concatenate([total[2], total[1], total[0][None, :]])
                used = np.flatnonzero(rows.any(axis=1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(rows[used, k]) for k in range(states)]], names=["symbol", *columns])

        summed = training.select("ids").mapInArrow(run, schema).groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
        rows = np.zeros((size + states + 1, states))
        rows[summed["symbol"]] = summed[columns]
        chain = fitted(rows[-1], rows[size : size + states], rows[:size], unigram)
    return chain


def score_texts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text, held_out).

    Tokens are white-space separated words, A-Z lower-cased, and one end per text. base_score is the smoothed unigram
    log10 probability; score is that of the hidden Markov model, exact for the whole text: the forward recursion over symbols, and
    within a shared symbol the word's smoothed frequency among the symbol's words (unseen words are one event, as in the base). Only rows
    with held_out false are learned from; all of them count. NULL and empty texts are the end alone; repeated rows are scored (and learned from)
    one by one; other columns are not read. Without training rows the base is 0 for every token.
    """
    plain = docs.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    head = head_words(plain.filter("not held_out"), options.pop("limit", HEAD_WORDS))
    size = len(head) + 1 + TAIL
    # uid is fixed by this table, from which everything below reads.
    coded = stored(symbols(plain, head), "zstd")
    training = coded.filter("not held_out")

    def tally(batches):
        total = np.zeros(size, dtype=np.int64)
        for part in slices(batches, "ids", _SLICE):
            total += np.bincount(chains(part, None)[0], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["symbol", "n"])

    tallied = training.select("ids").mapInArrow(tally, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, dtype=np.int64)
    counts[tallied["symbol"]] = tallied["n"]
    total = int(counts.sum())

    rare = coded.agg(F.sum("n_tail")).first()[0] or 0
    found = stored(rare_words(coded, max(1, -(-rare // BUCKET_WORDS))))
    distinct = np.zeros(TAIL, dtype=np.int64)

    def spread(batches):
        total = np.zeros(TAIL, dtype=np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                total[_unpacked_ids(keys)] += np.frombuffer(_full(counts), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAIL)), pa.array(total)], names=["symbol", "n"])

    # One row per shared symbol at most.
    kinds = found.filter("part is null").select("keys", "counts").mapInArrow(spread, "symbol long, n long")
    for row in kinds.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        distinct[row["symbol"]] = row["n"]
    vocabulary = int((counts[: len(head) + 1] > 0).sum() + distinct.sum())
    chain = baum_welch(training, (counts + 1) / (total + size), **options)

    own = np.zeros(size)
    own[len(head) + 1 :] = np.log10(counts[len(head) + 1 :] + distinct + 1)
    base = np.zeros(size)
    base[: len(head) + 1] = np.log10(counts[: len(head) + 1] + 1)
    seen = (counts > 0).astype(np.int64)
    seen[len(head) + 1 :] = 0
    shared = Shared(docs.sparkSession, (chain, own, base, seen))

    def run(batch: pa.RecordBatch) -> dict:
        chain, own, base, seen = shared.value
        ids, lengths = chains(batch, None)
        starts = np.cumsum(lengths) - lengths
        add = lambda values: np.add.reduceat(values[ids], starts) if len(starts) else np.zeros(0)
        out = {n: batch.column(n) for n in ("uid", "doc_id", "held_out", "n_tokens")}
        return out | {"known": add(seen), "base": add(base), "chain": chain.log10_likelihoods(ids, lengths) - add(own)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = map_slices(coded.select("uid", "doc_id", "held_out", "n_tokens", "ids"), run, f"uid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, chain double", "ids")
    tails = tail_sums(found)
    joined = parts.join(tails, "uid", "left")
    tail = F.coalesce("tail", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + tail - F.col("n_tokens") * float(np.log10(total + vocabulary + 1))).alias("base_score"),
        (F.col("chain") + tail).alias("score"),
    )
