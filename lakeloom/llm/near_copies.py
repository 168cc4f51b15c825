"""The second signature of `simhash.keep_first`: near copies whose fingerprints are far apart, by exact similarity.

Two texts are near copies if their sets of k-word shingles have a Jaccard similarity of at least the given one. Candidates come from
prefix filtering, which loses no pair: the shingles of each text are put in one order that holds for all texts, and two texts of
similarity s share one among the first n - ceil(s * n) + 1 of either. Any such order is right; this one puts shingles last that are in
many texts, as far as counts of bounded size tell (`Order`), so that common lines and passages make few candidates. A pair is dropped if
bits that tell apart the two sets, a few for each shingle, differ in more places than similar sets can (`sketch`). Of the others, each
text is first compared with the one that it shares most lists with; then, unless it is a near copy of that, with the rest. Every such
pair is confirmed on the shingles of both whole texts.

The texts of one prefix shingle are a list, in the order of the texts. Each turn compares all texts of a short list with each other, and
those of a longer one with its first, which leaves the list; then all texts that were found to be near copies leave all lists. So a large
group of near copies is never paired with itself. If long lists hardly shrink, their texts are no copies of each other: the rest is
compared pair by pair, a long list in chunks, each two of which are a task's worth.

Defined results: a document goes only if a document before it is a near copy of it, and no two that stay are near copies; each that goes
has a chain of near copies to one that stays. The order is by `_ord`, then by row. Documents are rows: repeated and null ids are as good as
others. Null and wordless texts stay. Words are split at ASCII white space and A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import cut, drop_path, hot_join, meet, release, ship, texts
from lakeloom.llm.simhash import shingle_hashes

#: Buckets of shingle hashes whose numbers of texts order the shingles; shingles known by themselves to be in many texts.
BUCKETS, KNOWN = 1 << 16, 200_000
#: Lists in which a hundredth of all texts are spread over so many tasks.
SPREAD = 64
#: Texts of a list that are all compared with each other in a turn; pairs of one text that a task confirms; texts of a list that are
#: paired with each other in one task at the end; rows of one list that a worker holds.
SHORT, PAIRS, LIST, HELD = 64, 1000, 1000, 100_000
SEED = 42

_EMPTY = np.empty(0, np.uint64)


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text, k, SEED))


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


class Order:
    """The common order of shingles: those known to be in many texts last, the others by the texts of their bucket."""

    def __init__(self, counts: np.ndarray, known: np.ndarray, times: np.ndarray, n_texts: int):
        self.counts, self.known, self.times, self.n_texts = counts, known, times, n_texts

    def times_of(self, hashes: np.ndarray) -> np.ndarray:
        """Texts that a shingle is known to be in, 0 if it is not known."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.times[at], 0)

    def first(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n hashes, and whether each is in at least a hundredth of all texts."""
        times = self.times_of(hashes)
        at = np.lexsort((hashes, self.counts[bucket(hashes)], times))[:n]
        return hashes[at], 100 * times[at] >= self.n_texts


def common_order(docs: DataFrame, k: int) -> Order:
    """Count the texts by bucket of their shingles; and by shingle, where one is in three texts of a batch."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            release()
            sets = [shingle_set(t, k) for t in texts(b.column(0))]
            every = np.concatenate([_EMPTY, *sets])
            total += np.bincount(bucket(every), minlength=BUCKETS)
            n += len(sets)
            every.sort()
            lead = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
            times = np.diff(np.append(lead, len(every)))
            often = times >= 3
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(often.sum(), np.int32)), pa.array(every[lead[often]].view(np.int64)), pa.array(times[often], pa.int64())], ["_kind", "_h", "_n"])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(at) + 1, np.int32)), pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["_kind", "_h", "_n"])

    found = docs.select("_text").mapInArrow(counts, "_kind int, _h long, _n long").groupBy("_kind", "_h").agg(F.sum("_n").alias("_n"))
    # At most the buckets and KNOWN shingles, those of most texts.
    rows = found.orderBy("_kind", F.desc("_n"), "_h").limit(BUCKETS + 1 + KNOWN).toPandas()
    small, known = rows[rows["_kind"] == 0], rows[rows["_kind"] == 1]
    out = np.zeros(BUCKETS, np.int64)
    at = small["_h"].to_numpy(np.int64)
    out[at[at >= 0]] = small["_n"].to_numpy(np.int64)[at >= 0]
    hashes = known["_h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Order(out, hashes[order], known["_n"].to_numpy(np.int64)[order], int(small["_n"].to_numpy(np.int64)[at < 0].sum()))


def prefixes(docs: DataFrame, order: Order, k: int, similarity: Fraction) -> DataFrame:
    """_h, _ord, _row, _spot (size * 2**32 + place) and _hot: each text's first shingles in the common order, with its size and their places."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            release()
            hashes, hot, sizes, lengths = [_EMPTY], [np.empty(0, bool)], [], []
            for t in texts(b.column(2)):
                s = shingle_set(t, k)
                h, often = shared.value.first(s, len(s) - ceil(similarity * len(s)) + 1 if len(s) else 0)
                hashes.append(h)
                hot.append(often)
                sizes.append(len(s))
                lengths.append(len(h))
            doc = np.repeat(np.arange(len(sizes)), lengths)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            spot = (np.repeat(np.array(sizes, np.int64), lengths) << 32) + at
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), b.column(0).take(take), b.column(1).take(take), pa.array(spot), pa.array(np.concatenate(hot))], ["_h", "_ord", "_row", "_spot", "_hot"])

    return docs.select("_ord", "_row", "_text").mapInArrow(first, "_h long, _ord long, _row long, _spot long, _hot boolean")


def possible(a: np.ndarray, b: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Whether two texts that share a prefix shingle at spots a and b, and none before it, can be similar by their sizes and its places."""
    num, den = similarity.numerator, similarity.denominator
    one, other = a >> 32, b >> 32
    rest = np.minimum(one - (a & 0xFFFFFFFF), other - (b & 0xFFFFFFFF))
    return rest * (num + den) >= (one + other) * num


def sketch(hashes: np.ndarray) -> bytes:
    """One bit for each value of the hash's first bits, four to eight times as many as hashes: whether it has an odd number of them.

    Two sets differ in at least as many hashes as their sketches differ in bits.
    """
    bits = max(6, 2 + int(len(hashes) - 1).bit_length()) if len(hashes) else 6
    return np.packbits(np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the larger one folded to the size of the other."""
    x, y = (np.unpackbits(np.frombuffer(z, np.uint8)) for z in (a, b))
    if len(x) < len(y):
        x, y = y, x
    return int((np.bitwise_xor.reduce(x.reshape(len(y), -1), axis=1) != y).sum())


def compare(rows: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Of whole lists (columns h, ord, row, spot; sorted): the pairs (rows of the earlier and the later text, and how many lists make them), and the places of rows that stay in long lists."""
    if not len(rows):
        return np.empty((0, 3), np.int64), np.empty(0, np.int64)
    lead = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
    size = np.diff(np.append(lead, len(rows)))
    end = np.repeat(lead + size, size)
    short = np.repeat(size <= SHORT, size)
    pairs = []
    at = np.flatnonzero(short)
    for step in range(1, SHORT):
        at = at[at + step < end[at]]
        good = at[possible(rows[at, 3], rows[at + step, 3], similarity)]
        pairs.append(np.stack([rows[good, 2], rows[good + step, 2]], 1))
    head = np.repeat(lead, size)
    rest = np.flatnonzero(~short & (head != np.arange(len(rows))))
    good = rest[possible(rows[head[rest], 3], rows[rest, 3], similarity)]
    pairs.append(np.stack([rows[head[good], 2], rows[good, 2]], 1))
    pairs, times = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
    return np.concatenate([pairs, times[:, None]], axis=1), rest


_KEYS = ["_h", "_ord", "_row"]
_OUT = "_x long, _y long, _c long, _h long, _ord long, _row long, _spot long, _hot boolean"


def turn(lists: DataFrame, similarity: Fraction) -> DataFrame:
    """One turn over lists (_h, _ord, _row, _spot, _hot): pairs (_x, _y, _c), and rows that stay in long lists (_x is null).

    Rows of hot lists are dealt out over many tasks and stay.
    """
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_row"), F.lit(SPREAD))).otherwise(0)
    lists = lists.withColumn("_salt", salt).repartition(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_h", "_salt").sortWithinPartitions("_hot", *_KEYS)

    def made(pairs: np.ndarray, rest: np.ndarray, hot: bool = False) -> pa.RecordBatch:
        n, m = len(pairs), len(rest)
        columns = [pa.array([*pairs[:, i].tolist(), *[None] * m], pa.int64()) for i in range(3)] + [pa.array([*[None] * n, *rest[:, i].tolist()], pa.int64()) for i in range(4)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([*[None] * n, *[hot] * m], pa.bool_())], ["_x", "_y", "_c", *_KEYS, "_spot", "_hot"])

    none = np.empty((0, 3), np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        head = None  # the first row of a list of which more than HELD rows have come

        def against(rows: np.ndarray) -> pa.RecordBatch:
            good = rows[possible(np.full(len(rows), head[3]), rows[:, 3], similarity)]
            return made(np.stack([np.full(len(good), head[2]), good[:, 2], np.ones(len(good), np.int64)], 1), rows)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]], axis=1)
            hot = batch.column(4).to_numpy(zero_copy_only=False)
            if hot.any():  # they come last
                yield made(none, rows[hot], True)
                rows = rows[~hot]
            if head is not None:
                same = rows[:, 0] == head[0]
                if same.any():
                    yield against(rows[same])
                    rows = rows[~same]
                if not len(rows):
                    continue
                head = None
            rows = np.concatenate([*held, rows])
            if not len(rows):
                continue
            whole = int(np.argmax(rows[:, 0] == rows[-1, 0]))
            pairs, rest = compare(rows[:whole], similarity)
            if len(pairs) or len(rest):
                yield made(pairs, rows[:whole][rest])
            held = [rows[whole:]]  # the last list may go on
            if len(held[0]) > HELD:
                head = held[0][0]
                yield against(held[0][1:])
                held = []
        if held:
            pairs, rest = compare(held[0], similarity)
            yield made(pairs, held[0][rest])

    return lists.select(*_KEYS, "_spot", "_hot").mapInArrow(search, _OUT)


def hot_turn(lists: DataFrame, similarity: Fraction) -> DataFrame:
    """The same for hot lists: each text meets its list's first in a broadcast, and the lists are not brought together."""
    first = lists.groupBy("_h").agg(F.min(F.struct("_ord", "_row", "_spot")).alias("_first"))
    met = lists.join(F.broadcast(first), "_h").where("_row <> _first._row")  # at most KNOWN lists
    num, den = similarity.numerator, similarity.denominator
    size, at = (lambda c: F.shiftright(c, 32)), (lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1)))
    fits = F.least(size("_spot") - at("_spot"), size("_first._spot") - at("_first._spot")) * (num + den) >= (size("_spot") + size("_first._spot")) * num
    none = F.lit(None).cast("long")
    pairs = met.where(fits).groupBy(F.col("_first._row").alias("_x"), F.col("_row").alias("_y")).agg(F.count("*").alias("_c"))
    return pairs.select("_x", "_y", "_c", *[none.alias(c) for c in [*_KEYS, "_spot"]], F.lit(None).cast("boolean").alias("_hot")).unionByName(met.select(*[none.alias(c) for c in ("_x", "_y", "_c")], *_KEYS, "_spot", "_hot"))


def pruned(pairs: DataFrame, docs: DataFrame, k: int, similarity: Fraction, top: str) -> DataFrame:
    """Those of the pairs (_x, _y, _c) whose sketches do not tell that they are not similar."""
    members = pairs.select(F.explode(F.array("_x", "_y")).alias("_of")).distinct()

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, k) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(map(sketch, sets), pa.binary())], ["_of", "_n", "_bits"])

    bits = cut(meet(docs, F.col("_row") == F.col("_of"), members, "left_semi").select("_row", "_text").mapInArrow(sketches, "_of long, _n long, _bits binary"), top, "sketches")
    both = hot_join(pairs, bits.toDF("_x", "_nx", "_bx"), "_x").join(bits.toDF("_y", "_ny", "_by"), "_y")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(3).to_numpy() + b.column(4).to_numpy()
            most = (similarity.denominator - similarity.numerator) * n // (similarity.denominator + similarity.numerator)
            apart = [bits_apart(x, y) for x, y in zip(b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)]
            keep = pa.array(np.array(apart, np.int64) <= most)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(keep) for i in range(3)], ["_x", "_y", "_c"])

    return cut(both.select("_x", "_y", "_c", "_nx", "_ny", "_bx", "_by").mapInArrow(near, "_x long, _y long, _c long"), top, "pruned")


def settle(pairs: DataFrame, docs: DataFrame, k: int, similarity: Fraction, top: str) -> DataFrame:
    """_of: the later documents of near copies among the pairs (_x, _y, _c, repeated for different lists). What it wrote but for these is deleted."""
    spark = pairs.sparkSession
    pairs = cut(pairs.groupBy("_x", "_y").agg(F.sum("_c").alias("_c")), f"{top}/work", "pairs")
    if pairs.limit(1).count():
        pairs = pruned(pairs, docs, k, similarity, f"{top}/work")
    if not pairs.limit(1).count():
        drop_path(spark, f"{top}/work")
        return spark.createDataFrame([], "_of long")
    best = cut(pairs.groupBy("_y").agg(F.max(F.struct("_c", -F.col("_x"))).alias("_b")).select((-F.col("_b.col2")).alias("_x"), "_y"), f"{top}/work", "best")
    gone = confirmed(best, docs, k, similarity, f"{top}/work", "best").select(F.col("_row").alias("_of"))
    rest = meet(pairs, F.col("_y") == F.col("_of"), gone, "left_anti")
    rest = rest.join(best.select(F.col("_x").alias("_bx"), F.col("_y").alias("_by")), (F.col("_x") == F.col("_bx")) & (F.col("_y") == F.col("_by")), "left_anti")
    gone = gone.union(confirmed(rest, docs, k, similarity, f"{top}/work", "rest").select(F.col("_row").alias("_of")))
    gone = cut(gone, top, "gone")
    drop_path(spark, f"{top}/work")
    return gone


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, similarity: Fraction, top: str, name: str) -> DataFrame:
    """_row of the later document (_y) of each pair whose whole texts are similar.

    A text goes to its pairs once for every PAIRS of them, not once a pair, and its shingles are taken once there.
    """
    spark = pairs.sparkSession
    pairs = cut(pairs.select("_x", "_y"), top, f"pairs_{name}")
    n = pairs.groupBy("_x").count().where(F.col("count") > PAIRS).select(F.col("_x").alias("_of"), F.ceil(F.col("count") / PAIRS).cast("int").alias("_parts"))
    parted = meet(pairs, F.col("_x") == F.col("_of"), n, "left")
    parted = parted.select("_x", "_y", F.pmod(F.xxhash64("_y"), F.coalesce("_parts", F.lit(1))).cast("int").alias("_part"))
    members = pairs.select(F.explode(F.array("_x", "_y")).alias("_of")).distinct()
    text = cut(meet(docs, F.col("_row") == F.col("_of"), members, "left_semi").select(F.col("_row").alias("_of"), "_text"), top, f"texts_{name}")
    heads = parted.select("_x", "_part").distinct().join(text, F.col("_x") == F.col("_of")).select("_x", "_part", F.lit(None).cast("long").alias("_y"), "_text")
    rows = heads.unionByName(parted.join(text, F.col("_y") == F.col("_of")).select("_x", "_part", "_y", "_text"))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_x", "_part").sortWithinPartitions("_x", "_part", F.asc_nulls_first("_y"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _EMPTY
        for b in batches:
            release()
            found = []
            for y, t in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                other = shingle_set(t, k)
                if y is None:
                    head = other
                    continue
                both = len(np.intersect1d(head, other, assume_unique=True))
                if both >= similarity * (len(head) + len(other) - both):
                    found.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["_row"])

    return cut(rows.select("_y", "_text").mapInArrow(similar, "_row long").distinct(), top, f"gone_{name}")


def all_pairs(lists: DataFrame, similarity: Fraction, top: str) -> DataFrame:
    """_x, _y, _c: all pairs of each list that can be similar. One of more than LIST texts is dealt into chunks; chunk c meets chunk d under (c, d), and itself under (c, c)."""
    sizes = cut(lists.groupBy("_h").agg(F.ceil(F.count("*") / LIST).cast("int").alias("_parts")).where("_parts > 1"), top, "long")
    parts = meet(lists, F.col("_h") == F.col("_of"), sizes.withColumnRenamed("_h", "_of"), "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    parts = parts.withColumn("_mine", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    size, at = F.shiftright("_spot", 32), F.col("_spot").bitwiseAND(F.lit((1 << 32) - 1))
    parts = parts.select("_h", "_ord", "_row", size.alias("_size"), (size - at).alias("_left"), "_mine", F.least("_mine", "_other").alias("_lo"), F.greatest("_mine", "_other").alias("_hi"))
    one, other = parts.alias("one"), parts.alias("other")
    num, den = similarity.numerator, similarity.denominator
    once = F.expr("one._mine < other._mine OR one._mine = other._mine AND one._lo = one._hi AND one._row < other._row")
    fits = F.expr(f"least(one._left, other._left) * {num + den} >= (one._size + other._size) * {num}")
    pairs = one.join(other, [*[F.col(f"one.{c}") == F.col(f"other.{c}") for c in ("_h", "_lo", "_hi")], once, fits])
    first = F.expr("one._ord < other._ord OR one._ord = other._ord AND one._row < other._row")
    a, b = F.col("one._row"), F.col("other._row")
    return pairs.select(F.when(first, a).otherwise(b).alias("_x"), F.when(first, b).otherwise(a).alias("_y"), F.lit(1).cast("long").alias("_c"))


def later_copies(docs: DataFrame, k: int, similarity: Fraction, top: str) -> DataFrame:
    """_row of the documents (_ord, _row, _text) that are near copies of one before them."""
    spark = docs.sparkSession
    ship(spark)
    found = turn(prefixes(docs, common_order(docs, k), k, similarity), similarity)
    out, number, before, before_hot = None, 0, None, False
    while True:
        found = cut(found, top, f"turn{number}")
        gone = settle(found.where("_x IS NOT NULL").select("_x", "_y", "_c"), docs, k, similarity, f"{top}/settled{number}")
        out = gone if out is None else out.union(gone)
        left = meet(found.where("_x IS NULL").select(*_KEYS, "_spot", "_hot"), F.col("_row") == F.col("_of"), gone, "left_anti")
        left = cut(left, top, f"left{number}")
        drop_path(spark, f"{top}/turn{number}")
        if number:
            drop_path(spark, f"{top}/left{number - 1}")
        n, hot = left.agg(F.count("*"), F.count_if("_hot")).first()
        if not n or before is not None and 4 * n > 3 * before and not before_hot:
            break
        found = turn(left.where("NOT _hot"), similarity)
        if hot:
            found = found.unionByName(hot_turn(left.where("_hot"), similarity))
        number, before, before_hot = number + 1, n, number == 0 and hot
    if n:
        out = out.union(settle(all_pairs(left, similarity, f"{top}/last"), docs, k, similarity, f"{top}/last"))
    return out.select(F.col("_of").alias("_row")).distinct()
