"""Operator 7: harmonic packing of tokenised documents into sequences."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curbflow.llm.common import slices, texts

CAPACITY = 2048
END_ID = 1
# Remainders are cut down to pieces of capacity / 2, / 4, ... as far as this size; what is left is smaller.
SMALLEST = 64
# tiktoken takes a time that grows with the square of a run of white space, and panics on a million; texts with a run of this length go through tokenizers.
LONG_SPACE = 128
_OUT = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def encoder(vocabulary: str, ranks: str, special: str = "<|endoftext|>"):
    """A function from text to ids. `ranks` is the byte-pair vocabulary of `vocabulary` in rank form, which encodes faster;
    texts that spell the special token go through the full tokenizer, which gives it its own id, and so do those with very long
    runs of white space, which tiktoken cannot take."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    full, spaces = [], re.compile(rf"\s{{{LONG_SPACE}}}")

    def encode(text: str) -> list[int]:
        if special not in text and (len(text) < LONG_SPACE or not spaces.search(text)):
            return fast.encode_ordinary(text)
        if not full:
            from tokenizers import Tokenizer

            full.append(Tokenizer.from_file(public_tokenizers.path(vocabulary)))
        return full[0].encode(text, add_special_tokens=False).ids

    return encode


class Bins:
    """The open sequences of one worker.

    A class holds pieces of at most capacity / k ids and more than capacity / (k + 1); k of them make a sequence. Full
    lengths and exact halves, quarters, ... waste nothing, so documents are cut into those first, and only a tail below
    `smallest` goes to a class whose sequences have a little padding.
    """

    def __init__(self, worker: int, capacity: int, smallest: int):
        self.capacity, self.smallest = capacity, smallest
        self.next_id = worker << 40
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            left = total - start
            size = self.capacity
            while size > left:
                size //= 2
            if size < self.smallest:
                size = left
            piece = (doc_id, start, ids[start : start + size], total)
            start += size
            count = self.capacity // size
            own = self.open.setdefault(count, [])
            own.append(piece)
            if len(own) == count:
                self.close(own)
                self.open[count] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), ids.tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        """What is left in unfilled classes, cut into sequences of powers of two, which need no padding."""
        pieces = [p for count in sorted(self.open) for p in self.open[count]]
        left = sum(len(p[2]) for p in pieces)
        pieces.reverse()
        while left:
            room = min(self.capacity, 1 << (left.bit_length() - 1))
            left -= room
            own = []
            while room:
                doc_id, start, ids, total = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc_id, start + room, ids[room:], total))
                    ids = ids[:room]
                own.append((doc_id, start, ids, total))
                room -= len(ids)
            self.close(own)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_OUT)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _OUT)], names=[n for n, _ in _OUT])


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
    end_id: int = END_ID,
    smallest: int = SMALLEST,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every worker (partition) packs its own rows: no shuffle, and a lost worker repeats only its own sequences. The ids of
    a document are those of its text and then end_id; a NULL or empty text is the end_id alone. Each id is in exactly one
    piece; sequences are gapless from offset 0 and have at most `capacity` ids. Repeated rows are packed each; a NULL
    doc_id stays NULL; other columns are not read; an empty table gives no rows. A worker holds one sequence per class
    at most. Capacity and smallest are powers of two.
    """

    def run(batches):
        from pyspark import TaskContext

        bins, encode = Bins(TaskContext.get().partitionId(), capacity, smallest), None
        for part in slices(batches):
            encode = encode or encoder(vocabulary, ranks)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                ids = encode(text.decode()) if text else []
                ids.append(end_id)
                bins.add(doc_id, np.array(ids, dtype="<u4"))
            yield bins.batch()
        bins.finish()
        yield bins.batch()

    from pyspark.sql import functions as F

    kept = docs.select(F.col("doc_id").cast("long"), "text")
    return kept.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
