"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The patterns are the windows of `window` consecutive words of the benchmark items (an item of fewer words, but not none,
is one window). The alphabet is the word: a block is the last few words before the cursor, the shift table tells how far
the cursor may skip, buckets of suffix hashes select the windows to test, and a direct comparison of the words' bytes
confirms each occurrence. Many cursors advance together in numpy arrays, over all documents of an Arrow batch.

The benchmark reaches the workers in blocks of at most `BLOCK_WORDS` words and `BLOCK_BYTES` bytes (longer items are cut into pieces
that overlap by a window less a word), one block at a time: this bounds what the driver holds and what is broadcast. A benchmark of one
block takes one pass over the documents without a shuffle; each further block takes a pass of its own, which writes down the documents it
hits, and these are put together by row.

Defined results: null or wordless texts have no words and no hits; repeated items count once by id; an item with a null id
counts under the empty id; repeated documents are each reported; an empty benchmark contaminates nothing; only the id and
text columns are read by `find_benchmark`, so other columns never clash. Texts are searched whole; the arrays of a very long one take
some tens of times its bytes in one worker.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import LOWER, buffer_of, cut, keep_rows, meet, mix, numbered, own_columns, pieces, shared_dir, ship, span_hashes, unused, word_spans

#: Words and bytes of benchmark items in one broadcast block at most (a window may have more); some 200 bytes of tables a word.
BLOCK_WORDS, BLOCK_BYTES = 500_000, 16 << 20
#: Words of the suffix block that the shift table is keyed by.
SUFFIX_WORDS = 3
#: End positions that one cursor covers.
LANE = 256

#: Bytes of words: digits, letters (after lower-casing) and all bytes of non-ASCII characters.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x41:0x5B] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

_STEP = np.uint64(0xD1342543DE82EF95)


def words_of(raw: np.ndarray, offsets: np.ndarray):
    """(starts, ends, word hashes, words before each row) of lower-cased bytes."""
    starts, ends, before = word_spans(raw, offsets, WORD_BYTES)
    return starts, ends, span_hashes(raw, starts, ends), before


def chain(hashes: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that end at each position of `last`."""
    h = np.zeros(len(last), np.uint64)
    for k in range(n - 1, -1, -1):
        h = (h + hashes[last - k]) * _STEP
    return mix(h)


class Patterns:
    """Shift table and buckets for the windows of one length."""

    def __init__(self, length: int, windows: dict[bytes, set[str]]):
        self.length, self.block = length, min(SUFFIX_WORDS, length)
        self.text = sorted(windows)
        self.items = [sorted(windows[w]) for w in self.text]
        raw = np.frombuffer(b"\n".join(self.text), np.uint8)
        starts, _, before = word_spans(raw, np.array([0, len(raw)]), WORD_BYTES)
        _, _, hashes, _ = words_of(raw, np.array([0, len(raw)]))
        ends = np.arange(1, len(self.text) + 1) * length - 1
        suffix = chain(hashes, ends, self.block)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.whole = chain(hashes, ends, length)[self.order]
        self.bits = int(np.clip(np.ceil(np.log2(16 * len(starts) + 1)), 12, 25))
        most = length - self.block + 1
        self.shift = np.full(1 << self.bits, most, np.int16)
        for j in range(length - self.block, -1, -1):  # from the largest shift to 0
            self.shift[self.slot(chain(hashes, ends - j, self.block))] = j

    def slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, hashes: np.ndarray, before: np.ndarray, same) -> tuple[np.ndarray, np.ndarray]:
        """(last word, pattern) of each occurrence; `same(last, pattern)` compares the words themselves."""
        first = before[:-1] + self.length - 1
        n_lanes = np.maximum(0, -((first - before[1:]) // LANE))
        row = np.repeat(np.arange(len(first)), n_lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        at = first[row] + nth * LANE
        stop = np.minimum(at + LANE, before[1:][row])
        found_at, found = [], []
        while len(at):
            h = chain(hashes, at, self.block)
            shift = self.shift[self.slot(h)]
            here = shift == 0
            if here.any():
                p, h = at[here], h[here]
                lo, hi = np.searchsorted(self.suffix, h, "left"), np.searchsorted(self.suffix, h, "right")
                p, lo, hi = p[hi > lo], lo[hi > lo], hi[hi > lo]
                while len(p):  # one test string of each bucket at a time
                    whole = chain(hashes, p, self.length)
                    k = lo + 0
                    hit = self.whole[k] == whole
                    for q, x in zip(p[hit], self.order[k[hit]], strict=True):
                        if same(int(q), self.text[x]):
                            found_at.append(q)
                            found.append(x)
                    lo = lo + 1
                    left = lo < hi
                    p, lo, hi = p[left], lo[left], hi[left]
            at = at + np.maximum(shift, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        return np.array(found_at, np.int64), np.array(found, np.int64)


_KEEP = bytes(b if WORD_BYTES[b] else 32 for b in LOWER)


def words_in(text: str) -> list[bytes]:
    return text.encode().translate(_KEEP).split()


def windows_of(items: list[tuple[str, list[bytes]]], window: int) -> dict[int, dict[bytes, set[str]]]:
    """For each length in words, the windows of that length (words joined by one space) and the ids of their items."""
    out: dict[int, dict[bytes, set[str]]] = {}
    for item, words in items:
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            out.setdefault(n, {}).setdefault(b" ".join(words[i : i + n]), set()).add(item)
    return out


def parts_of(words: list[bytes], window: int) -> Iterator[list[bytes]]:
    """The words of one item in parts that fit a block; each window is in just one of them."""
    first, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if i - first >= window and (i - first >= BLOCK_WORDS or size > BLOCK_BYTES):
            yield words[first:i]
            first = i - window + 1
            size = sum(len(x) + 1 for x in words[first : i + 1])
    yield words[first:]


def blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> Iterator[list[Patterns]]:
    """The benchmark's tables, a block at a time. Items are read partition by partition."""
    held: list[tuple[str, list[bytes]]] = []
    n = size = 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    for row in rows.toLocalIterator():
        for part in parts_of(words_in(row["text"]), window):
            more = sum(map(len, part)) + len(part)
            if held and (n + len(part) > BLOCK_WORDS or size + more > BLOCK_BYTES):
                yield [Patterns(k, v) for k, v in sorted(windows_of(held, window).items())]
                held, n, size = [], 0, 0
            if part:
                held.append((row["item"] or "", part))
                n, size = n + len(part), size + more
    if held:
        yield [Patterns(k, v) for k, v in sorted(windows_of(held, window).items())]


def search_batch(column: pa.Array, tables: list[Patterns]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[set[str]]]:
    """For each text: number of words, number of hit words, hit flags by word, ids of the items found."""
    n_words, n_hit, flags, items = [], [], [], []
    sizes = np.diff(buffer_of(column)[1])
    for lo, hi in pieces(sizes):
        raw, offsets = buffer_of(column.slice(lo, hi - lo))
        raw = LOWER[raw]
        starts, ends, hashes, before = words_of(raw, offsets)
        cover = np.zeros(len(starts) + 1, np.int32)
        ids: list[set[str]] = [set() for _ in range(hi - lo)]
        for t in tables:

            def same(last: int, text: bytes, n: int = t.length, raw=raw, starts=starts, ends=ends) -> bool:
                return b" ".join(raw[starts[i] : ends[i]].tobytes() for i in range(last - n + 1, last + 1)) == text

            last, which = t.search(hashes, before, same)
            np.add.at(cover, last - t.length + 1, 1)
            np.add.at(cover, last + 1, -1)
            for row, x in zip(np.searchsorted(before, last, "right") - 1, which, strict=True):
                ids[row].update(t.items[x])
        hit = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_words.append(np.diff(before))
        n_hit.append(total[before[1:]] - total[before[:-1]])
        flags += [hit[a:b] for a, b in zip(before[:-1], before[1:], strict=True)]
        items += ids
    empty = [np.empty(0, np.int64)]
    return np.concatenate(n_words or empty), np.concatenate(n_hit or empty), flags, items


def first_blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> tuple[list[Patterns] | None, Iterator[list[Patterns]]]:
    """(the only block, nothing) or (None, all blocks)."""
    every = blocks(benchmark, window, item_col, text_col)
    one, two = next(every, []), next(every, None)
    return (one, iter(())) if two is None else (None, itertools.chain([one, two], every))


def hits_of(rows: DataFrame, every: Iterator[list[Patterns]], top: str) -> DataFrame:
    """_row, hits (bits by word) and items for each block and each row (_row, _text) that it hits: one pass a block, whose broadcast ends with it."""
    spark, out = rows.sparkSession, None
    for number, tables in enumerate(every):
        shared = spark.sparkContext.broadcast(tables)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, n_hit, flags, items = search_batch(b.column(1), shared.value)
                at = np.flatnonzero(n_hit)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([np.packbits(flags[i]).tobytes() for i in at], pa.binary()), pa.array([sorted(items[i]) for i in at], pa.list_(pa.string()))], ["_row", "hits", "items"])

        found = cut(rows.mapInArrow(step, "_row long, hits binary, items array<string>"), top, f"hits{number}")
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted ids) and contaminated. See the module for null and other special cases."""
    spark = docs.sparkSession
    ship(spark)
    only, every = first_blocks(benchmark, window, item_col, item_text_col)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    shared = spark.sparkContext.broadcast(only or [])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_hit, _, items = search_batch(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["_id", "n_words", "n_hit", "items"])

    if only is None:
        top = shared_dir(spark)
        rows = cut(df.withColumn("_row", F.monotonically_increasing_id()), top, "rows")
        hits = hits_of(rows.select("_row", "_text"), every, top).groupBy("_row").agg(F.collect_list("hits").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = [int(np.bitwise_count(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in held])).sum()) for held in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), b.column(2)], ["_of", "_hit", "_items"])

        hits = cut(hits.select("_row", "hits", "items").mapInArrow(merge, "_of long, _hit long, _items array<string>"), top, "merged")
        counted = rows.select(F.struct("_id", "_row").alias("_key"), "_text").mapInArrow(search, f"_id struct<_id: {kind}, _row: long>, n_words long, n_hit long, items array<string>")
        counted = counted.select(F.col("_id._row").alias("_row"), F.col("_id._id").alias("_id"), "n_words")
        none = F.array().cast("array<string>")
        df = meet(counted, F.col("_row") == F.col("_of"), hits, "left").select("_id", "n_words", F.coalesce("_hit", F.lit(0)).alias("n_hit"), F.coalesce("_items", none).alias("items"))
    else:
        df = df.mapInArrow(search, f"_id {kind}, n_words long, n_hit long, items array<string>")
    return df.select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs` in whose text no window of the benchmark occurs, with all their columns; with one block nothing is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    only, every = first_blocks(benchmark, window, item_col, item_text_col)
    if only is not None:
        shared = spark.sparkContext.broadcast(only)
        return keep_rows(docs, text_col, lambda c: search_batch(c, shared.value)[1] == 0)
    top, row, key = shared_dir(spark), unused("_row", docs), unused("_hit", docs)
    rows = numbered(docs, row, top)
    at = dict(zip(rows.columns, own_columns(rows), strict=True))
    hits = hits_of(rows.select(at[row].alias("_row"), at[text_col].cast("string").alias("_text")), every, top)
    return meet(rows, at[row] == F.col(key), hits.select(F.col("_row").alias(key)).distinct(), "left_anti").select(own_columns(docs))


def digest(items: Column) -> Column:
    """Hex SHA-256 of the comma-joined sorted ids."""
    return F.sha2(F.array_join(items, ","), 256)


def brute_force(text: str | None, benchmark: list[tuple[object, str | None]], window: int = 10) -> tuple[int, int, int, str, bool]:
    """The same result for one text by a plain scan, for tests."""
    import re

    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words, hit, found = pattern.findall(lower(text)), set(), set()
    for item, other in benchmark:
        w = pattern.findall(lower(other))
        n = min(window, len(w))
        wanted = {tuple(w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)}
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in wanted:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)
