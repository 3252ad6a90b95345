"""Operator 2: benchmark decontamination with a generalised suffix automaton over words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import Shared, drop_stored, map_slices, stored, texts

# Item words that one automaton holds; more items than that are streamed past the documents in blocks.
BLOCK_WORDS = 100_000

# A-Z lower-cased; every other ASCII byte that is neither a digit nor a letter becomes a space.
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def item_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, a-z and non-ASCII characters; none for NULL."""
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences: every state stands for phrases with the same continuations."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.shortest = min([window, *(len(words) for _, words in coded)])
        # State of a window -> names of the items that hold it. `short`: whole items of fewer words, by state.
        self.names: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, set]]] = {}
        for name, words in coded:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.short.setdefault(state, []).append((len(words), {name}))
            else:
                for end, state, _ in self.matches(words):
                    if end >= window - 1:
                        self.names.setdefault(self._at(state, window), set()).add(name)
        if self.short:
            order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
            for state in order:
                above = self.short.get(self.link[state])
                if above:
                    self.short[state] = self.short.get(state, []) + above

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last != -1:
            target = self.next[last][word]
            exact = self.length[target] == self.length[last] + 1
            self.link[state] = target if exact else self._clone(last, word, target)
        return state

    def _clone(self, last: int, word: int, target: int) -> int:
        copy = len(self.link)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[last] + 1)
        self.link[target] = copy
        while last != -1 and self.next[last].get(word) == target:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _at(self, state: int, length: int) -> int:
        """The state of the last `length` words of a phrase of the state."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[int]):
        """(position, state, length) of the longest phrase of any item that ends at each position."""
        state = length = 0
        for position, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield position, state, length

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Spans of words inside windows (merged), the items with such windows, and the longest phrase in common."""
        coded = np.fromiter((self.ids.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], coded >= 0, [False]]).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        names: set = set()
        longest = 0
        # Phrases shorter than the shortest window can't hit, so only long enough runs of known words are streamed.
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.shortest:
                continue
            for position, state, length in self.matches(coded[start:end].tolist()):
                longest = max(longest, length)
                reach = 0
                if length >= self.window:
                    reach = self.window
                    names |= self.names.get(self._at(state, self.window), set())
                for size, own in self.short.get(state, ()):
                    if size <= length:
                        reach = max(reach, size)
                        names |= own
                if reach:
                    first = start + position - reach + 1
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append((first, start + position + 1))
        return spans, names, longest


def automata(items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> Iterator[tuple[Automaton, bool]]:
    """One automaton after the other for blocks of items, and whether it is the last; without items an empty one.

    Blocks are dealt by the item's hash and hold about block_words words; repeated items count once. The driver holds one
    block at a time, however many items there are.
    """

    def run(batch: pa.RecordBatch) -> dict:
        words = [b" ".join(item_words(t)) for t in texts(batch)]
        return {"item_id": batch.column("item_id"), "words": words, "n": [w.count(b" ") + 1 for w in words]}

    kept = items.select(F.col("item_id").cast("string"), "text").filter("text is not null")
    kept = stored(map_slices(kept, run, "item_id string, words binary, n long").distinct())
    blocks = max(1, -(-(kept.agg(F.sum("n")).first()[0] or 0) // block_words))
    kept = kept.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    for block in range(blocks):
        own = kept.filter(F.col("block") == block).sort("item_id", "words").collect()
        yield Automaton([(r["item_id"], bytes(r["words"]).split()) for r in own], window), block + 1 == blocks


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, items (ids as sorted strings), longest.

    A window is `window` consecutive words of an item; an item of fewer words is one window. n_hit counts the document's
    words inside any occurrence of a window, `items` lists the items that have such windows, `longest` is the longest
    phrase in common with one item (of the phrases that can hit). NULL and empty texts have no words and no hits; items without words never
    match; an item with a NULL id is matched but not listed; items with the same id are listed once. Repeated rows are
    judged one by one; other columns of docs are not read. No items: nothing is hit. Nothing is shuffled: the automaton
    of a block of bounded size is broadcast, and the documents stream past one block after the other.
    """
    result = docs.select("doc_id", "text")
    schema = "doc_id {kind}, text string, n_words long, spans array<struct<start: int, end: int>>, items array<string>, longest long"
    kind = result.schema["doc_id"].dataType.simpleString()
    for automaton, last in automata(items, window, block_words):
        shared = Shared(docs.sparkSession, automaton)
        result = map_slices(result, _scanner(shared, not last), schema.format(kind=kind))
        if not last:
            result = stored(result)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return result.select("doc_id", "n_words", hit.alias("n_hit"), "items", "longest")


def _scanner(shared, keep_text: bool):
    def run(batch: pa.RecordBatch) -> dict:
        automaton = shared.value
        before = batch.schema.get_field_index("spans") >= 0
        out: dict = {"n_words": [], "spans": [], "items": [], "longest": []}
        earlier = [batch.column(c).to_pylist() for c in ("spans", "items", "longest")] if before else None
        for k, text in enumerate(texts(batch)):
            words = item_words(text)
            spans, names, longest = automaton.scan(words)
            if earlier is not None:
                spans = merged(spans + [(s["start"], s["end"]) for s in earlier[0][k]])
                names = names | set(earlier[1][k])
                longest = max(longest, earlier[2][k])
            out["n_words"].append(len(words))
            out["spans"].append([{"start": a, "end": b} for a, b in spans])
            out["items"].append(sorted(n for n in names if n is not None))
            out["longest"].append(longest)
        text_column = batch.column("text") if keep_text else pa.nulls(batch.num_rows, pa.string())
        return out | {"doc_id": batch.column("doc_id"), "text": text_column}

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without the spans that items hold; documents with more than max_coverage of their words in such spans go.

    Spans are cut from the text as often as cutting brings new ones together; n_chars, where it is a column, is counted
    anew for changed texts. All other columns, and all rows without a hit, stay as they are (NULL and empty texts too). The result does not
    depend on `block_words`: with several blocks of items the spans of all are merged before a text is judged and cut, and
    texts that were cut pass all blocks again until none has a hit.
    """
    counted = "n_chars" in docs.columns
    automaton, only = next(automata(items, window, block_words))
    if not only:
        return _in_rounds(docs, items, window, max_coverage, block_words)
    shared = Shared(docs.sparkSession, automaton)

    def run(batch: pa.RecordBatch) -> dict | None:
        automaton, keep, changed = shared.value, [], {}
        for k, text in enumerate(texts(batch)):
            cut, coverage = without_items(text, automaton)
            if coverage <= max_coverage:
                keep.append(k)
                if coverage:
                    changed[k] = cut.decode()
        out = {n: batch.column(n).take(pa.array(keep, pa.int64())) for n in batch.schema.names}
        if changed:
            plain, new = batch.column("text").to_pylist(), out["text"].to_pylist()
            new = [changed.get(k, plain[k]) for k in keep]
            out["text"] = new
            if counted:
                old = batch.column("n_chars").to_pylist()
                out["n_chars"] = [len(changed[k]) if k in changed else old[k] for k in keep]
        return out

    return map_slices(docs, run, _ddl(docs))


def _in_rounds(docs: DataFrame, items: DataFrame, window: int, max_coverage: float, block_words: int) -> DataFrame:
    """`decontaminate` for several blocks: spans of all of them, one cut, and again for the texts that were cut."""
    spans = "array<struct<start: int, end: int>>"
    pending = docs.select(F.struct("*").alias("row"), "text", F.lit(None).cast(spans).alias("spans"), F.lit(True).alias("new"))
    # own: the stored table that only the next pass reads.
    schema, done, own = pending.schema, [], None

    def found(shared: Shared):
        def run(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(n) for n in batch.schema.names}
            merged_spans = []
            for text, earlier in zip(texts(batch), batch.column("spans").to_pylist()):
                own, _, _ = shared.value.scan(item_words(text))
                merged_spans.append([{"start": a, "end": b} for a, b in merged(own + [(s["start"], s["end"]) for s in earlier or []])])
            return out | {"spans": merged_spans}

        return run

    def cut(batch: pa.RecordBatch) -> dict:
        keep, text = [], []
        for k, (own, places, new) in enumerate(zip(texts(batch), batch.column("spans").to_pylist(), batch.column("new").to_pylist())):
            inside = [(s["start"], s["end"]) for s in places]
            if new and inside and sum(b - a for a, b in inside) > max_coverage * len(item_words(own)):
                continue
            keep.append(k)
            text.append(without_spans(own, inside).decode() if inside else batch.column("text")[k].as_py())
        out = {n: batch.column(n).take(pa.array(keep, pa.int64())) for n in batch.schema.names}
        return out | {"text": text, "new": [False] * len(keep)}

    while True:
        for automaton, _ in automata(items, window, block_words):
            before, pending = own, stored(map_slices(pending, found(Shared(docs.sparkSession, automaton)), schema))
            drop_stored(before)
            own = pending
        after = stored(map_slices(pending, cut, schema))
        drop_stored(own)
        own = None
        done.append(after.filter(F.size("spans") == 0))
        again = after.filter(F.size("spans") > 0)
        if again.isEmpty():
            break
        pending = own = stored(again.withColumn("spans", F.lit(None).cast(spans)))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))
    columns = []
    for name in docs.columns:
        own = F.col("row").getField(name)
        if name == "text":
            own = F.col("text")
        elif name == "n_chars":
            own = F.when(changed, F.length("text").cast(docs.schema[name].dataType)).otherwise(own)
        columns.append(own.alias(name))
    return whole.select(*columns)


def without_items(text: bytes | None, automaton: Automaton) -> tuple[bytes, float]:
    """The text without its windows, and the share of its words that were inside windows at first."""
    text, coverage = text or b"", 0.0
    while True:
        words = item_words(text)
        spans, _, _ = automaton.scan(words)
        if not spans:
            return text, coverage
        coverage = coverage or sum(b - a for a, b in spans) / len(words)
        text = without_spans(text, spans)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans."""
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*parts, text[at:]])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
