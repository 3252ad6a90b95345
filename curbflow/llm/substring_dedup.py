"""Operator 10: passages that repeat across documents, by paragraph MinHash banding."""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.buckets import dealt
from curbflow.llm.common import LOWER, drop_stored, map_slices, spent, stored, stored_parts, texts
from curbflow.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
# Anchors are sequences of ANCHOR_WORDS words: of every ANCHOR_WINDOW neighbouring ones that with the least hash, so any run of
# ANCHOR_WORDS + ANCHOR_WINDOW - 1 = PASSAGE_WORDS equal words holds an equal anchor, whatever stands around it.
ANCHOR_WORDS, ANCHOR_WINDOW = 8, 23
# Words on each side of a repeated anchor that are compared with its first occurrence; the next anchor is nearer.
REACH = 32
# Neighbouring repeated parts make a passage if they have this many words together; paragraphs are compared by shingles from as many on.
PASSAGE_WORDS = 30
# Fewer words than this between two of them (a changed sentence) belong to the passage.
GAP_WORDS = 12
# Paragraphs of one band bucket that meet in one task at most; larger buckets are dealt out as pairs of blocks.
BLOCK = 1024
# Shingles whose signature is computed at once.
CHUNK = 4096

# Odd multipliers, different for each place of a word in a sequence.
_POWERS = np.cumprod(np.full(max(SHINGLE, ANCHOR_WORDS), 0x9E3779B97F4A7C15, np.uint64))

# A word is a run without white space; letters of scripts without spaces between words (Chinese, Japanese, Thai, Lao, Khmer, Burmese) are one each.
_WORD = re.compile(
    rb"\xe0[\xb8-\xbb][\x80-\xbf]|\xe1(?:[\x80-\x82]|[\x9e\x9f])[\x80-\xbf]|[\xe3-\xe9][\x80-\xbf]{2}|\xf0[\xa0-\xbf][\x80-\xbf]{2}|"
    rb"(?:[^ \t-\r\xe0\xe1\xe3-\xe9\xf0]|\xe0[^\xb8-\xbb]|\xe1[^\x80-\x82\x9e\x9f]|\xf0[^\xa0-\xbf])+"
)


# Lead bytes of blocks that hold such letters (others of these blocks are told apart by _WORD).
_ONE_EACH = re.compile(rb"[\xe0\xe1\xe3-\xe9\xf0]")


def tuned_bands(similarity: float = SIMILARITY, recall: float = 0.998, hashes: int = 48) -> tuple[int, int]:
    """(bands, rows) with the most rows per band that still find a pair of the similarity with the recall, within `hashes`."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


def hashed(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all sequences of `width` words in order, of word hashes (the whole if it is shorter)."""
    width = min(width, len(hashes))
    mixed = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        mixed += hashes[k : len(hashes) - width + 1 + k] * _POWERS[k]
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)


def band_mixers(bands: int, rows: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of the MinHash functions, the same in every task."""
    factor, shift = np.random.default_rng(seed).integers(1, 1 << 63, (2, bands * rows), dtype=np.uint64)
    return factor | np.uint64(1), shift


def band_hashes(shingles: np.ndarray, bands: int, rows: int, mixers: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """One number per band of the MinHash signature."""
    factor, shift = mixers or band_mixers(bands, rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), CHUNK):
        spread = np.multiply.outer(shingles[k : k + CHUNK].astype(np.uint64) + np.uint64(1), factor)
        spread += shift
        np.minimum(least, spread.min(axis=0), out=least)
    # The least of the upper bits are the upper bits of the least.
    least = (least >> np.uint64(20)).tobytes()
    return np.array([xxhash.xxh64_intdigest(least[8 * rows * k : 8 * rows * (k + 1)], k) for k in range(bands)], dtype=np.uint64)


_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def word_spans(text: bytes) -> np.ndarray:
    """Byte spans of the words, one row each."""
    if _ONE_EACH.search(text):
        return np.array([m.span() for m in _WORD.finditer(text)], np.int64).reshape(-1, 2)
    edges = np.flatnonzero(np.diff(_SPACE[np.frombuffer(b" %b " % text, np.uint8)].view(np.int8)))
    return edges.reshape(-1, 2)


def split_words(text: bytes, spans: np.ndarray) -> list[bytes]:
    return [text[a:b] for a, b in spans.tolist()] if _ONE_EACH.search(text) else text.split()


def layout(text: bytes, starts: np.ndarray, ends: np.ndarray, least: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """Word ranges of the paragraphs with at least `least` words: lines of as many words, and runs of shorter lines without a blank line."""
    out, first, line = [], 0, 0
    ends_of_lines = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    breaks = np.searchsorted(ends_of_lines, starts[1:]) - np.searchsorted(ends_of_lines, ends[:-1])
    at = (np.flatnonzero(breaks) + 1).tolist()

    def end(a: int, b: int) -> None:
        if b - a >= least:
            out.append((a, b))

    for k, n in zip([*at, len(starts)], [*breaks[breaks > 0].tolist(), 2]):
        if k - line >= least:
            end(first, line)
            end(line, k)
            first = k
        elif n > 1:
            end(first, k)
            first = k
        line = k
    return out


def _over_windows(values: np.ndarray, larger) -> np.ndarray:
    """The minimum or maximum of every window of ANCHOR_WINDOW values, by doubling."""
    width = 1
    while 2 * width <= ANCHOR_WINDOW:
        values, width = larger(values[:-width], values[width:]), 2 * width
    rest = ANCHOR_WINDOW - width
    return larger(values[:-rest], values[rest:]) if rest else values


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the anchors: the same run of words has the same anchors wherever it stands.

    Of equal hashes in a row within one window (a text that repeats itself) the first is enough.
    """
    if len(hashes) < ANCHOR_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    every = sequence_hashes(hashes, ANCHOR_WORDS)
    if len(every) <= ANCHOR_WINDOW:
        at = np.array([every.argmin()])
    else:
        least = _over_windows(every, np.minimum)
        # A sequence is the least of some window if the largest of the least of its windows is its own.
        edge = np.zeros(ANCHOR_WINDOW - 1, np.uint64)
        at = np.flatnonzero(_over_windows(np.concatenate([edge, least, edge]), np.maximum) == every)
    digests = every[at]
    if (digests[1:] == digests[:-1]).any():
        kept, last = [], None
        for k, place in enumerate(at.tolist()):
            if last is None or digests[k] != digests[last] or place - at[last] >= ANCHOR_WINDOW:
                kept.append(k)
                last = k
        at, digests = at[kept], digests[kept]
    return at, digests


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))


def same_words(own: np.ndarray, other: np.ndarray) -> int:
    """How many words at the start are equal."""
    n = min(len(own), len(other))
    differ = np.flatnonzero(own[:n] != other[:n])
    return int(differ[0]) if len(differ) else n


def paragraphs(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, start, end (bytes), digest, anchor of every paragraph that is compared and every anchor.

    Rows with bands and shingles stand for no place but hold those of a digest, once for all of its paragraphs in a batch. Words are as in word_spans, A-Z lower-cased.
    """

    def run(batch: pa.RecordBatch) -> dict:
        row, start, end, digest, banded, anchored = [], [], [], [], {}, []
        mixers = band_mixers(bands, rows)
        for k, text in enumerate(texts(batch)):
            if not text:
                continue
            lower = text.translate(LOWER)
            spans = word_spans(lower)
            if not len(spans):
                continue
            hashes = hashed(split_words(lower, spans))
            starts, ends = spans[:, 0], spans[:, 1]
            found = layout(lower, starts, ends)
            every = (sequence_hashes(hashes, SHINGLE) >> np.uint64(32)).astype(np.uint32) if found else None
            for a, b in found:
                own = xxhash.xxh64_intdigest(hashes[a:b].tobytes(), 10)
                row.append(k), start.append(starts[a]), end.append(ends[b - 1]), digest.append(own)
                if own not in banded:
                    shingles = np.unique(every[a : max(a + 1, b - SHINGLE + 1)])
                    banded[own] = band_hashes(shingles, bands, rows, mixers).view(np.int64), shingles.tobytes()
            at, digests = anchors(hashes)
            if len(at):
                anchored.append((np.full(len(at), k), starts[at], ends[at + ANCHOR_WORDS - 1], digests))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        more = [np.concatenate(c) for c in zip(empty, *anchored)]
        places, extra = len(row) + len(more[0]), len(banded)
        without = np.arange(places + extra) >= places
        held = np.zeros(extra, np.int64)
        rows_of = pa.array(np.concatenate([np.array(row, np.int64), more[0], held]), mask=without)
        digests = np.concatenate([np.array(digest, np.uint64), more[3], np.array([*banded], np.uint64)])
        none = pa.nulls(places, pa.list_(pa.int64())), pa.nulls(places, pa.binary())
        return {
            "doc_id": batch.column("doc_id").take(rows_of),
            "text_hash": batch.column("text_hash").take(rows_of),
            "start": pa.array(np.concatenate([np.array(start, np.int64), more[1], held]).astype(np.int32), mask=without),
            "end": pa.array(np.concatenate([np.array(end, np.int64), more[2], held]).astype(np.int32), mask=without),
            "digest": digests.view(np.int64),
            "anchor": pa.array(np.arange(places + extra) >= len(row), mask=without),
            "bands": pa.concat_arrays([none[0], pa.array([b for b, _ in banded.values()], pa.list_(pa.int64()))]),
            "shingles": pa.concat_arrays([none[1], pa.array([s for _, s in banded.values()], pa.binary())]),
        }

    kept = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return map_slices(kept, run, "doc_id long, text_hash long, start int, end int, digest long, anchor boolean, bands array<long>, shingles binary")


def similar_paragraphs(found: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) of digests that connect all paragraphs that share a band and have the similarity, exactly verified.

    Copies count once. A bucket with more than BLOCK paragraphs is cut into blocks by digest, and every pair of blocks is
    one task's work, so every pair of paragraphs still meets. A task returns a spanning forest of its links.
    """
    own = found.filter("bands is not null")
    banded = own.groupBy("digest").agg(F.first("bands").alias("bands"))
    keyed = dealt(banded.select("digest", F.explode("bands").alias("band")), BLOCK)
    wanted = keyed.select("digest").distinct()
    members = own.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("shingles").alias("shingles"))
    joined = keyed.join(members, "digest")
    grouped = joined.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y", "digest")

    def run(batches):
        key, members = None, []
        for batch in batches:
            links = []
            columns = [batch.column(c).to_pylist() for c in ("band", "x", "y", "digest", "shingles")]
            for band, x, y, digest, shingles in zip(*columns):
                if (band, x, y) != key:
                    links += verified(members, similarity)
                    key, members = (band, x, y), []
                members.append((digest, shingles))
            yield _links(links)
        yield _links(verified(members, similarity))

    return grouped.mapInArrow(run, "a long, b long").distinct()


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(members: list[tuple[int, bytes]], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest over the members with at least this Jaccard similarity; connected ones aren't compared again."""
    if len(members) < 2:
        return []
    sets = [set(np.frombuffer(s, dtype=np.uint32).tolist()) for _, s in members]
    root = list(range(len(members)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links = []
    for i, left in enumerate(sets):
        for j in range(i + 1, len(sets)):
            right = sets[j]
            if similarity * len(left) > len(right) or similarity * len(right) > len(left) or find(i) == find(j):
                continue
            common = len(left & right)
            if common >= similarity * (len(left) + len(right) - common):
                root[find(j)] = find(i)
                links.append((members[i][0], members[j][0]))
    return links


def repeated_spans(docs: DataFrame, similarity: float = SIMILARITY, recall: float = 0.998) -> DataFrame:
    """doc_id, text_hash, spans (byte starts and ends) of the paragraphs and anchors whose first occurrence is in another document.

    Parts that are equal, or linked by similar ones, are one class; its first occurrence (smallest doc_id, NULL
    first, then place) stays, and so does any other in the same document. Anchors have the hashes of the words before (backwards) and after their
    first occurrence in `before` and `after`.
    """
    every = paragraphs(docs, *tuned_bands(similarity, recall)).withColumn("kind", F.col("bands").isNotNull().cast("int"))
    found, sets = stored_parts(every, "kind", 2)
    found, sets = found.drop("bands", "shingles"), sets.select("digest", "bands", "shingles")
    links = stored(similar_paragraphs(sets, similarity))
    spent(sets)
    roots = components(links)
    drop_stored(links)
    place = F.struct("doc_id", "text_hash", "start", "end")
    anchor = F.bool_or("anchor").alias("anchor")
    counted = found.groupBy("digest").agg(F.min(place).alias("first"), F.max(F.struct("doc_id", "text_hash")).alias("last"), anchor)
    counted = counted.join(roots, counted["digest"] == roots["node"], "left")
    # Only what occurs twice, or is like something else, goes on: a small part of all paragraphs.
    several = counted.filter("root is not null or first.doc_id <=> last.doc_id = false or first.text_hash <> last.text_hash")
    several = stored(several.select("digest", F.coalesce("root", "digest").alias("class"), "first", "anchor"))
    spent(roots)
    keepers = several.groupBy("class").agg(F.min("first").alias("keeper"))
    kept = several.join(keepers, "class").select("digest", "anchor", F.col("keeper.doc_id").alias("kept_id"), F.col("keeper.text_hash").alias("kept_hash"), "keeper")
    kept = stored(kept)
    spent(several)
    around = stored(contexts(docs, kept.filter("anchor")))
    again = found.select("doc_id", "text_hash", "start", "end", "digest").join(kept.drop("keeper", "anchor"), "digest")
    again = again.filter(~(F.col("doc_id").eqNullSafe(F.col("kept_id")) & F.col("text_hash").eqNullSafe(F.col("kept_hash"))))
    again = again.join(around, "digest", "left")
    spans = again.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end", "before", "after"))).alias("spans"))
    spans = stored(spans)
    spent(found, kept, around)
    return spans


def contexts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """digest, before, after: hashes of the words on either side (REACH of them, those before backwards) of every anchor's first occurrence."""
    places = chosen.groupBy(F.col("kept_id").alias("_id"), F.col("kept_hash").alias("_hash")).agg(
        F.collect_list(F.struct("digest", "keeper.start", "keeper.end")).alias("places")
    )
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("text").eqNullSafe(F.col("_hash"))

    def run(batch: pa.RecordBatch) -> dict:
        digest, before, after = [], [], []
        for text, places in zip(texts(batch), batch.column("places").to_pylist()):
            words = Words(text)
            for place in places:
                own = words.around(place["start"], place["end"])
                digest.append(place["digest"]), before.append(own[0].tobytes()), after.append(own[1].tobytes())
        return {"digest": digest, "before": before, "after": after}

    found = map_slices(rows.join(places, same).select("text", "places"), run, "digest long, before binary, after binary")
    return found.groupBy("digest").agg(F.first("before").alias("before"), F.first("after").alias("after"))


class Words:
    """Words of a text by place."""

    def __init__(self, text: bytes):
        lower = text.translate(LOWER)
        self.spans = word_spans(lower)
        self.hashes = word_hashes(split_words(lower, self.spans))
        self.starts = self.spans[:, 0]

    def around(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words before (backwards) and after a byte span."""
        a, b = np.searchsorted(self.starts, [start, end]).tolist()
        return self.hashes[max(0, a - REACH) : a][::-1], self.hashes[b : b + REACH]

    def extended(self, start: int, end: int, before: bytes | None, after: bytes | None) -> tuple[int, int]:
        """The word range of a byte span, with the words on both sides that equal those of another occurrence."""
        a, b = np.searchsorted(self.starts, [start, end]).tolist()
        if before is None:
            return a, b
        left = same_words(self.hashes[max(0, a - REACH) : a][::-1], np.frombuffer(before, np.uint32))
        right = same_words(self.hashes[b : b + REACH], np.frombuffer(after, np.uint32))
        return a - left, b + right


def passages(ranges: list[tuple[int, int]], least: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """Word ranges of the runs of repeated paragraphs that have enough words; a short gap between two is part of the run."""
    runs: list[list[int]] = []
    for a, b in ranges:
        if runs and a - runs[-1][1] < GAP_WORDS:
            runs[-1][2] += max(0, b - max(a, runs[-1][1]))
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b, b - a])
    return [(a, b) for a, b, repeated in runs if repeated >= least]


def substring_dedup(docs: DataFrame, similarity: float = SIMILARITY, least: int = PASSAGE_WORDS, recall: float = 0.998) -> DataFrame:
    """docs with the repeated passages cut from all but the first document that holds them.

    Adds `passages` (array of start, end in characters of the old text, and words) and `removed_words`; n_chars, where it is a column, is
    counted anew for changed texts. Texts without a repeated passage, NULL and empty ones included, stay as they are. Rows with the same
    doc_id and text are one document and get the same result. Columns of docs with the names of the added ones are replaced.
    """
    names = [c for c in docs.columns if c not in ("passages", "removed_words")]
    rows = docs.select(*names)
    spans = repeated_spans(docs, similarity, recall).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & F.xxhash64("text").eqNullSafe(F.col("_hash"))
    joined = rows.join(spans, same, "left").drop("_id", "_hash")
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n) for n in names}
        cut, removed, changed = [], [], {}
        for k, spans in enumerate(batch.column("_spans").to_pylist()):
            runs = []
            if spans:
                text = batch.column("text")[k].as_py().encode()
                words = Words(text)
                wide = {words.extended(s["start"], s["end"], s["before"], s["after"]) for s in spans}
                found = passages(sorted(wide), least)
                runs = [(int(words.spans[a, 0]), int(words.spans[b - 1, 1]), b - a) for a, b in found]
            if runs:
                changed[k] = without(text, runs)
            cut.append([{"start": len(text[:a].decode()), "end": len(text[:b].decode()), "words": n} for a, b, n in runs])
            removed.append(sum(n for _, _, n in runs))
        if changed:
            out["text"] = [changed.get(k, t) for k, t in enumerate(batch.column("text").to_pylist())]
            if "n_chars" in out:
                out["n_chars"] = [len(changed[k]) if k in changed else n for k, n in enumerate(batch.column("n_chars").to_pylist())]
        return out | {"passages": cut, "removed_words": removed}

    added = "passages array<struct<start: int, end: int, words: int>>, removed_words long"
    return map_slices(joined, run, f"{fields}, {added}")


def without(text: bytes, runs: list[tuple[int, int, int]]) -> str:
    """The text without the runs and the white space after them."""
    kept, at = [], 0
    for a, b, _ in runs:
        kept.append(text[at:a])
        at = b
        while at < len(text) and text[at] in b" \t\r\n\x0b\x0c":
            at += 1
    return b"".join([*kept, text[at:]]).decode()
