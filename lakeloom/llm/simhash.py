"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a small Hamming distance by pigeonring filtering.

A fingerprint's 64 bits are a ring of `max_bits + 1` segments. If two fingerprints differ in at most `max_bits` bits, some
segment starts a chain in which the first l segments together differ in at most floor(l * max_bits / (max_bits + 1)) bits,
for every l. So the first segment of the chain is equal (the key that pairs are searched under), the second differs in at
most one bit (found by sorting under each one-bit mask), and the longer prefixes of the chain are tested before the full
Hamming distance.

Equal fingerprints are one class from the start. Distinct fingerprints are searched by (segment, value). A value of more than
`CHUNK` fingerprints is searched under the chain's second segment too, by one-bit masks, so a task holds more only of fingerprints that agree
in about 25 bits; there, too many for a walk over pairs are divided again by the bits in which they differ. A task returns a spanning
forest of what it links, not pairs. Components come from alternating star contractions over tables in the shared folder.

`keep_first` keeps one document of each component. With a `similarity` it then drops near copies whose fingerprints differ in more bits:
candidates by a second signature (`near_copies`), each confirmed on whole texts.

Defined results: null or wordless texts have fingerprint 0 and link like any other; repeated documents are each reported;
a null id is smaller than none (it is a component id only where all ids of the component are null); ties do not matter; an empty table
gives no rows; only the id and text columns are read, so other columns never clash. A very long text takes a few times its bytes in one
worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lakeloom.llm.common import cut, drop_path, hot_join, is_small, meet, numbered, own_columns, ship, shared_dir, texts, unused

#: Fingerprints of one (segment, value) that are searched under that segment alone, and of one key whose pairs are walked over.
CHUNK, WALK = 4096, 256


def shingle_hashes(text: bytes, k: int, seed: int) -> np.ndarray:
    """XXH64 of each k-word shingle of A-Z lower-cased text, repeats included; fewer words make one shingle, none make none."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= k:
        return np.array([xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(line[a:b], seed) for a, b in spans), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """The value whose bit i is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """_id and _fp (a signed 64-bit number) of each document."""
    ship(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([majority(shingle_hashes(t, k, seed)) for t in texts(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["_id", "_fp"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(prints, f"_id {kind}, _fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ring's segments, as even as can be."""
    m = max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the classes of a[i] and b[i]; `labels` holds each node's smallest member, before and after."""
    while len(a):
        x, y = labels[a], labels[b]
        far = x != y
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while len(a) and not np.array_equal(jumped := labels[labels], labels):
            labels[:] = jumped


class Chains:
    """The chain test under a segment: masks of its first n segments by start."""

    def __init__(self, max_bits: int):
        self.max_bits, self.ring = max_bits, segments(max_bits)
        m = len(self.ring)
        self.masks = [np.array([sum(_mask(*self.ring[(s + i) % m]) for i in range(n)) for s in range(m)], np.uint64) for n in range(1, m + 1)]

    def near(self, a: np.ndarray, b: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Whether the chains of 1, 2, ... segments that start there stay within their budgets, the last of which is the whole distance."""
        m, differ = len(self.ring), a ^ b
        at = np.arange(len(differ))
        for n in range(1, m + 1):
            at = at[np.bitwise_count(differ[at] & self.masks[n - 1][segment[at]]) <= n * self.max_bits // m]
        out = np.zeros(len(differ), bool)
        out[at] = True
        return out


def walk(fp: np.ndarray, order: np.ndarray, lead: np.ndarray, segment: np.ndarray, labels: np.ndarray, chains: Chains) -> None:
    """Link all pairs within each run of `order` (runs begin at `lead`) that are not linked yet."""
    end = np.repeat(np.append(lead[1:], len(order)), np.diff(np.append(lead, len(order))))
    at, step = np.arange(len(order)), 1
    while len(at := at[at + step < end[at]]):
        i, j = order[at], order[at + step]
        far = labels[i] != labels[j]
        i, j = i[far], j[far]
        near = chains.near(fp[i], fp[j], segment[i])
        join_labels(labels, i[near], j[near])
        step += 1


def link_large(fp: np.ndarray, members: np.ndarray, segment: np.ndarray, labels: np.ndarray, chains: Chains) -> None:
    """Link the members (of one key) without walking over all their pairs.

    Neighbours by one bit are looked up. The bits in which the members differ are dealt into `max_bits + 1` parts, one of which is equal in
    any two near ones, and each part's groups of equal value are taken in turn, until they are small.
    """
    some = np.sort(fp[members])
    place = members[np.argsort(fp[members])]
    vary = int(np.bitwise_or.reduce(some ^ some[0]))
    for b in range(64):
        if vary >> b & 1:
            to = np.minimum(np.searchsorted(some, some ^ np.uint64(1 << b)), len(some) - 1)
            there = np.flatnonzero(some[to] == some ^ np.uint64(1 << b))
            there = there[chains.near(some[there], some[to[there]], segment[place[there]])]
            join_labels(labels, place[there], place[to[there]])
    left = [members]
    while left:
        members = left.pop()
        if (labels[members] == labels[members[0]]).all():
            continue
        some = fp[members]
        vary = int(np.bitwise_or.reduce(some ^ some[0]))
        bits = [b for b in range(64) if vary >> b & 1]
        parts = [x for x in np.array_split(np.array(bits, np.uint64), chains.max_bits + 1) if len(x)]
        if len(parts) <= chains.max_bits:  # too few bits to differ in more
            walk(fp, members, np.array([0]), segment, labels, chains)
            continue
        for part in parts:
            key = some & np.uint64(sum(1 << int(b) for b in part))
            order = np.argsort(key, kind="stable")
            key, held = key[order], members[order]
            lead = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(lead, len(held)))
            left += [held[a : a + n] for a, n in zip(lead[size > WALK], size[size > WALK], strict=True)]
            small = np.repeat(size <= WALK, size)
            if small.any():
                n = size[size <= WALK]
                walk(fp, held[small], np.cumsum(n) - n, segment, labels, chains)


def link_sorted(fp: np.ndarray, group: np.ndarray, segment: np.ndarray, max_bits: int) -> np.ndarray:
    """Labels of fingerprints that come in groups: within a group, pigeonring candidates under `segment` are linked if at most `max_bits` bits differ."""
    chains = Chains(max_bits)
    ring, m = chains.ring, len(chains.ring)
    labels = np.arange(len(fp))
    lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(fp) else np.empty(0, np.int64)
    size = np.diff(np.append(lead, len(fp)))
    for a, n in zip(lead[size > WALK], size[size > WALK], strict=True):
        link_large(fp, np.arange(a, a + n), segment, labels, chains)
    small = np.flatnonzero(np.repeat(size <= WALK, size))
    if not len(small):
        return labels
    second = [np.array([(1 << (ring[(s + 1) % m][0] + j)) if j < ring[(s + 1) % m][1] else 0 for s in range(m)], np.uint64) for j in range(max(w for _, w in ring))]
    both = chains.masks[min(1, m - 1)][segment]
    for bit in second if m > 1 else [np.zeros(m, np.uint64)]:
        key = (fp & both & ~bit[segment])[small]
        order = np.lexsort((key, group[small]))
        g, k = group[small][order], key[order]
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])]))
        walk(fp, small[order], first, segment, labels, chains)
    return labels


def links(prints: DataFrame, max_bits: int, top: str) -> DataFrame:
    """a > b: links between distinct fingerprints (column _fp) that connect all that differ in at most `max_bits` bits."""
    spark = prints.sparkSession
    ring = segments(max_bits)
    value = [F.shiftrightunsigned("_fp", a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in ring]
    keyed = prints.select("_fp", F.inline(F.array(*[F.struct(F.lit(i).alias("_seg"), v.cast("int").alias("_val")) for i, v in enumerate(value)])))
    whole = F.lit(0).cast("long").alias("_two")
    if len(ring) > 1:
        # At most (max_bits + 1) * 2**width values, whatever the input: counted to find those too large to be searched under one segment.
        large = F.broadcast(keyed.groupBy("_seg", "_val").count().where(F.col("count") > CHUNK).select("_seg", "_val", F.lit(True).alias("_large")))
        keyed = keyed.join(large, ["_seg", "_val"], "left")
        # By segment: the next segment's value without each of its bits in turn, with the bit's number above it.
        masked = [F.array(*[value[(s + 1) % len(ring)].bitwiseAND(F.lit(((1 << w) - 1) & ~(1 << j))).cast("long") + F.lit((j + 1) << 40) for j in range(w)]) for s, w in enumerate([*[w for _, w in ring[1:]], ring[0][1]])]
        small = keyed.where("_large IS NULL").select("_seg", "_val", whole, "_fp")
        keyed = small.unionByName(keyed.where("_large").select("_seg", "_val", F.explode(F.element_at(F.array(*masked), F.col("_seg") + 1)).alias("_two"), "_fp"))
    else:
        keyed = keyed.select("_seg", "_val", whole, "_fp")
    keys = ["_seg", "_val", "_two"]
    keyed = keyed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            change = np.concatenate([[0], np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(1))])
            fp = rows[:, 3].copy().view(np.uint64)
            labels = link_sorted(fp, change, rows[:, 0], max_bits)
            far = labels != np.arange(len(labels))
            a, b = rows[far, 3], rows[labels[far], 3]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            if held and (rows[-1, :3] == held[0][0, :3]).all():  # the group that goes on takes the whole batch
                held.append(rows)
                continue
            rows = np.concatenate([*held, rows])
            same = (rows[:, :3] == rows[-1, :3]).all(1)
            whole = len(rows) - int(same[::-1].argmin() if not same.all() else len(rows))
            held = [rows[whole:]]  # the last group may go on
            if whole:
                yield linked(rows[:whole])
        if held:
            yield linked(np.concatenate(held))

    return cut(keyed.select(*keys, "_fp").mapInArrow(forest, "a long, b long").distinct(), top, "links")


def components(edges: DataFrame, top: str) -> DataFrame:
    """node, root (the smallest node it is connected to), for each node of the edges a > b that is not a root itself."""
    spark = edges.sparkSession

    def measure(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    old, turn, before = None, 0, measure(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        # Large star: neighbours above u hang on the smallest neighbour of u (or u).
        stars = hot_join(both, least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        stars = cut(stars, top, f"large{turn}")
        # Small star: u and its smaller neighbours hang on the smallest of them.
        least = stars.groupBy("a").agg(F.min("b").alias("_m"))
        low = hot_join(stars, least, "a").select(F.explode(F.array("b", "a")).alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
        edges = cut(low, top, f"small{turn}")
        for name in old or []:
            drop_path(spark, f"{top}/{name}")
        old, turn = [f"large{turn}", f"small{turn}"], turn + 1
        after = measure(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, max_bits: int = 4, k: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id, the smallest id among all that its links reach."""
    spark = docs.sparkSession
    top = shared_dir(spark)
    prints = cut(fingerprints(docs, k, seed, id_col, text_col), top, "prints")
    distinct = cut(prints.groupBy("_fp").agg(F.min("_id").alias("_least")), top, "distinct")
    roots = components(links(distinct.select("_fp"), max_bits, top), top)
    of = distinct.join(roots, distinct["_fp"] == roots["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    of = cut(of, top, "rooted")
    found = cut(hot_join(of, of.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select("_fp", "component_id"), top, "classes")
    every = hot_join(prints, found, "_fp")
    return every.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, max_bits: int = 4, k: int = 4, seed: int = 42, similarity: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of each component, by id, then by row, with all columns of `docs`; a null id comes last. Rows that share an id, or have none, are documents of their own.

    With a similarity, a row also goes if its set of k-word shingles has that Jaccard similarity, or more, with an earlier row's: by id if
    ids are integers, else by their hash.
    """
    from lakeloom.llm.near_copies import later_copies

    spark = docs.sparkSession
    top, row, key = shared_dir(spark), unused("_row", docs), unused("_gone", docs)
    rows = numbered(docs, row, top)
    at = dict(zip(rows.columns, own_columns(rows), strict=True))
    place = F.struct(at[id_col].isNull().alias("_null"), at[id_col].alias("_id"), at[row].alias("_row"))
    near = near_duplicates(rows.select(place.alias("_place"), at[text_col].alias("_text")), max_bits, k, seed, "_place", "_text")
    gone = cut(near.where("_place._row <> component_id._row").select(F.col("_place._row").alias(key)), top, "gone_by_print")
    if similarity is not None:
        first = meet(rows, at[row] == F.col(key), gone, "left_anti")
        if not is_small(gone):  # else each reading of the texts would move them all again
            first = cut(first, top, "first")
        whole = isinstance(docs.schema[id_col].dataType, IntegralType)
        order = F.coalesce(at[id_col].cast("long"), F.lit((1 << 63) - 1)) if whole else F.xxhash64(at[id_col])
        plain = first.select(order.alias("_ord"), at[row].alias("_row"), at[text_col].cast("string").alias("_text"))
        gone = gone.union(later_copies(plain, k, Fraction(str(similarity)), f"{top}/near"))
    gone = cut(gone, top, "gone")
    drop_path(spark, f"{top}/near")
    drop_path(spark, f"{top}/first")
    return meet(rows, at[row] == F.col(key), gone, "left_anti").select(own_columns(docs))
