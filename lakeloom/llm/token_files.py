"""Token ids in files: canonical length-limited Huffman coding from global counts.

`write_tokens` encodes each text, counts all ids, derives one code (package-merge, at most `LONGEST` bits), sorts the documents'
ids by document and writes two tables under a path: `code` (id, length: the canonical code follows from these) and `blocks`.
A block holds whole consecutive documents: their ids and lengths, the code bits, and the bit offset of every `EVERY`-th id,
so each block, and each stretch between checkpoints, decodes on its own. `read_tokens` decodes by table: all stretches of a
batch advance together, one table look-up an id.

Encoding is the library's own. A text is cut at some of the places where the byte-level pattern always begins a new
word (`cuts`), and each distinct chunk of at most `SHORT` bytes is encoded once while it is remembered: chunks are looked up by hash and
all their bytes are compared on every hit, so the ids are always those of the library. A tokenizer of another build gets whole texts.

Defined results: a null or empty text has only the end id; repeated documents are each written (ties of the id go by the hash of the
text); null ids come first; an empty table has an empty file; only the id and text columns are read, so other columns never clash.
A very long text is encoded a piece at a time and is one block of its own.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import buffer_of, drop_path, mix, pieces, release, ship

#: Bytes of text that are cut and looked up at once; slots of each of the memory's two tables, as a power of two.
ENCODE_BYTES, SLOTS = 1 << 20, 22
#: Longest code in bits; ids between two checkpoints; ids of a block, save for longer documents; remembered chunks, and bytes of each at most.
LONGEST, EVERY, BLOCK_IDS, REMEMBERED, SHORT = 20, 128, 1 << 16, 950_000, 32

#: Bytes that surely end a character other than white space (of the others, some end a Unicode space).
_NO_SPACE = np.zeros(256, bool)
_NO_SPACE[0x21:0x7F] = _NO_SPACE[0x8B:0xC0] = True
_NO_SPACE[[0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
#: First bytes of characters that surely are no white space, ASCII white space, ASCII letters, ASCII marks.
_NO_SPACE_FIRST = np.zeros(256, bool)
_NO_SPACE_FIRST[0x21:0x7F] = _NO_SPACE_FIRST[0xC3:0xE1] = True
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_MARK = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))


def white_space(raw: np.ndarray) -> np.ndarray:
    """Flags of bytes that begin a white-space character of UTF-8 text: those of ASCII, and all of Unicode."""
    padded = np.concatenate([raw, np.zeros(2, np.uint8)])
    one, two = padded[1:-1], padded[2:]
    out = _BLANK[raw] | (raw >= 0x1C) & (raw <= 0x1F)
    out |= (raw == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (raw == 0xE1) & (one == 0x9A) & (two == 0x80) | (raw == 0xE3) & (one == 0x80) & (two == 0x80)
    out |= (raw == 0xE2) & ((one == 0x80) & ((two <= 0x8A) | np.isin(two, [0xA8, 0xA9, 0xAF])) | (one == 0x81) & (two == 0x9F))
    return out


def cuts(raw: np.ndarray, offsets: np.ndarray, at_marks: bool) -> np.ndarray:
    """Flags of bytes that begin a chunk: places where the byte-level pattern always ends one word and begins another.

    These are white space after a non-space, a non-space after a lone white space other than a blank, and (`at_marks`) a
    punctuation mark after a letter.
    """
    blank = _BLANK[raw]
    begins = np.zeros(len(raw), bool)
    begins[1:] = blank[1:] & _NO_SPACE[raw[:-1]]
    lone = begins & (raw != 0x20)
    begins[1:] |= lone[:-1] & _NO_SPACE_FIRST[raw[1:]]
    if at_marks:
        letter = _LETTER[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7) & (raw[1:] >= 0x80)
        begins[1:] |= letter[:-1] & _MARK[raw[1:]]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return begins


def chunk_keys(raw: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows of numbers that two chunks of at most SHORT bytes share just if their bytes are equal: their length, then eight bytes each."""
    padded = np.concatenate([raw, np.zeros(SHORT, np.uint8)])
    words = np.ndarray((len(raw) + SHORT - 7,), "<u8", padded, strides=(1,))
    out = np.empty((1 + SHORT // 8, len(starts)), np.uint64)
    out[0] = n
    for i in range(SHORT // 8):
        left = np.clip(n - 8 * i, 0, 8).astype(np.uint64)
        mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left & np.uint64(7)) * np.uint64(8)) - np.uint64(1))
        out[i + 1] = words[starts + np.minimum(8 * i, n)] & mask
    return out


def key_hashes(keys: np.ndarray) -> np.ndarray:
    h = mix(keys[0] + keys[1])
    for k in keys[2:]:
        h = mix(h + k)
    return h


class Encoder:
    """Ids of whole texts as the library gives them."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = Tokenizer.from_file(file)
        pre, added = self.model.pre_tokenizer, list(self.model.get_added_tokens_decoder().values())
        plain = isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space and self.model.normalizer is None and self.model.truncation is None and self.model.padding is None
        self.by_chunk = plain and not any(re.search(r"\s", t.content) or t.lstrip or t.rstrip or t.single_word for t in added)
        self.added = [t.content for t in added]
        self.line_end = self.model.encode("\n", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        #: By number of a remembered chunk: its key and the end of its ids in the store; these grow by doubling. Two tables by hash tell the
        #: number; a chunk that finds both its slots taken takes the first one, and the chunk that was there is learned again when it comes.
        self.count = 0
        self.keys, self.ends = np.zeros((1 + SHORT // 8, 1 << 12), np.uint64), np.zeros(1 << 12, np.int64)
        self.store = np.empty(1 << 14, np.int32)
        self.tables = [np.full(1 << SLOTS, -1, np.int32) for _ in range(2)]

    def slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        return [(hashes >> np.uint64(64 - SLOTS)).astype(np.int64), (hashes & np.uint64((1 << SLOTS) - 1)).astype(np.int64)]

    def number_of(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Numbers of chunks, -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for table, slot in zip(self.tables, self.slots(hashes), strict=True):
            left = np.flatnonzero(out < 0)
            number = table[slot[left]]
            left, number = left[number >= 0], number[number >= 0]
            same = self.keys[0, number] == keys[0, left]
            for i in range(1, len(keys)):
                same &= self.keys[i, number] == keys[i, left]
            out[left[same]] = number[same]
        return out

    def reserve(self, ids: int) -> None:
        """Room for so many more ids."""
        while len(self.store) < self.ends[self.count] + ids:
            self.store = np.concatenate([self.store, np.empty_like(self.store)])

    def remember(self, keys: np.ndarray, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Add chunks with their ids, which are in another order; the new numbers."""
        first, n = self.count, len(hashes)
        self.reserve(len(ids))
        while len(self.ends) <= first + n:
            self.ends = np.concatenate([self.ends, np.empty_like(self.ends)])
            self.keys = np.concatenate([self.keys, np.empty_like(self.keys)], axis=1)
        used, number = int(self.ends[first]), first + place
        self.count += n
        self.ends[first + 1 : self.count + 1] = used + np.cumsum(sizes)
        self.store[used : used + len(ids)] = ids
        self.keys[:, number] = keys
        one, two = self.slots(hashes)
        second = (self.tables[0][one] >= 0) & (self.tables[1][two] < 0)
        self.tables[0][one[~second]] = number[~second]
        self.tables[1][two[second]] = number[second]
        return number

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column, without added special tokens."""
        if not self.by_chunk:
            return [np.array(e.ids, np.int32) for e in self.model.encode_batch_fast([x or "" for x in column.to_pylist()], add_special_tokens=False)]
        out: list[np.ndarray] = []
        sizes = np.diff(buffer_of(column)[1])
        for lo, hi in pieces(sizes, ENCODE_BYTES):
            out += self._piece(*buffer_of(column.slice(lo, hi - lo)))
        return out

    def _learn(self, raw: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all chunks one after another, how many each has, and the place of each chunk in that order.

        Chunks without white space, but for a blank before them, are encoded in one text, divided by line ends, which are tokens of their
        own there.
        """
        stop = np.cumsum(n)
        chars = raw[np.arange(stop[-1]) + np.repeat(starts - stop + n, n)]
        odd = white_space(chars)
        odd[(stop - n)[(chars[stop - n] == 0x20) & (n > 1)]] = False
        below = np.concatenate([[0], np.cumsum(odd)])
        simple = below[stop] == below[stop - n]
        text = lambda i: chars[stop[i] - n[i] : stop[i]].tobytes().decode()
        if len(self.line_end) != 1:
            simple[:] = False
        elif any(t.encode() in chars.tobytes() for t in self.added):
            simple &= np.array([not any(t in text(i) for t in self.added) for i in range(len(n))], bool)
        ids, sizes = np.empty(0, np.int32), np.empty(0, np.int64)
        if simple.any():
            size = n[simple] + 1
            lines = np.full(int(size.sum()), 0x0A, np.uint8)
            inside = np.ones(len(lines), bool)
            inside[np.cumsum(size) - 1] = False
            lines[inside] = chars[np.repeat(simple, n)]
            ids = np.array(self.model.encode_batch_fast([lines[:-1].tobytes().decode()], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(ids == self.line_end[0])
            if len(ends) == len(size) - 1:
                sizes = np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1
                ids = np.delete(ids, ends)
            else:
                simple[:], ids = False, ids[:0]
        alone = [e.ids for e in self.model.encode_batch_fast([text(i) for i in np.flatnonzero(~simple)], add_special_tokens=False)]
        ids = np.concatenate([ids, *(np.array(x, np.int32) for x in alone)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, alone), np.int64, len(alone))])
        place = np.empty(len(n), np.int64)
        place[np.argsort(~simple, kind="stable")] = np.arange(len(n))
        return ids, sizes, place

    def _numbers(self, raw: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Number of each short chunk, remembered now if it was not; -1 for one whose hash is that of another new one."""
        keys = chunk_keys(raw, starts, n)
        hashes = key_hashes(keys)
        number = self.number_of(keys, hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, first, chunk = np.unique(hashes[new], return_index=True, return_inverse=True)
            first = new[first]
            learned = self.remember(keys[:, first], hashes[first], *self._learn(raw, starts[first], n[first]))
            same = (keys[:, new] == keys[:, first[chunk]]).all(0)
            number[new] = np.where(same, learned[chunk], -1)
        return number

    def _piece(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        whole = raw.tobytes()
        starts = np.flatnonzero(cuts(raw, offsets, not any(t.encode() in whole for t in self.added)))
        n = np.append(starts[1:], len(raw)) - starts
        before = np.searchsorted(starts, offsets)
        if self.count > REMEMBERED:
            self.forget()
        number = np.full(len(starts), -1, np.int64)
        short = n <= SHORT
        number[short] = self._numbers(raw, starts[short], n[short])
        alone = np.flatnonzero(number < 0)
        start, sizes = self.ends[number], self.ends[number + 1] - self.ends[number]
        if len(alone):  # encoded for this piece only, behind the remembered ids
            made = [e.ids for e in self.model.encode_batch_fast([whole[a : a + m].decode() for a, m in zip(starts[alone].tolist(), n[alone].tolist(), strict=True)], add_special_tokens=False)]
            sizes[alone] = [len(x) for x in made]
            stop = np.cumsum(sizes[alone])
            self.reserve(int(stop[-1]))
            start[alone] = used = self.ends[self.count] + stop - sizes[alone]
            self.store[used[0] : used[0] + stop[-1]] = np.concatenate([np.array(x, np.int32) for x in made])
        stop = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.store[np.repeat(start - stop[:-1], sizes) + np.arange(stop[-1])]
        return [flat[a:b] for a, b in zip(stop[before[:-1]], stop[before[1:]], strict=True)]


@functools.lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def limited_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Code lengths of least total size with none above `longest` (package-merge), for positive counts in ascending order."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} symbols need more than {longest} bits")
    packed, is_leaf = np.empty(0, np.int64), []
    for _ in range(longest):
        every = np.concatenate([counts, packed])
        order = np.argsort(every, kind="stable")
        is_leaf.append(order < n)
        every = every[order]
        packed = every[0 : len(every) // 2 * 2 : 2] + every[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols in code order, their codes): codes of a length are consecutive numbers, by id."""
    order = np.lexsort((ids, lengths))
    ids, lengths = ids[order], lengths[order]
    top = int(lengths.max(initial=1))
    widths = np.int64(1) << (top - lengths)
    return order, (np.cumsum(widths) - widths) >> (top - lengths)


class Code:
    """A canonical code from the table (id, length)."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order, codes = canonical(ids, lengths)
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.top = int(lengths.max(initial=1))
        size = int(ids.max(initial=0)) + 1
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids], self.length[ids] = codes.astype(np.uint64), lengths
        #: For each `top` bits that may come next: id and length of the code they begin with.
        self.table = np.repeat((ids << 8 | lengths).astype(np.int64), np.int64(1) << (self.top - lengths))
        self.table = np.concatenate([self.table, np.full((1 << self.top) - len(self.table), 1, np.int64)])

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Code bits of the ids (big-endian words of 32 bits), and the bit offset of every EVERY-th id."""
        n = self.length[ids]
        end = np.cumsum(n)
        start = end - n
        value = self.code[ids] << (64 - (start & 31) - n).astype(np.uint64)
        word = start >> 5
        words = np.zeros((int(end[-1]) >> 5) + 3 if len(ids) else 2)
        words += np.bincount(word, (value >> np.uint64(32)).astype(np.float64), len(words))
        words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words))
        return words.astype(np.uint64).astype(">u4").tobytes(), start[::EVERY]

    def unpack(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of each (bits, checkpoints, number of ids); all stretches of all blocks together."""
        words = np.concatenate([np.frombuffer(b, ">u4") for b, _, _ in blocks]).astype(np.uint64)
        base = np.cumsum([0, *(len(b) // 4 for b, _, _ in blocks)])[:-1] * 32
        at = np.concatenate([c.astype(np.int64) + x for (_, c, _), x in zip(blocks, base, strict=True)])
        lanes = np.array([len(c) for _, c, _ in blocks])
        left = np.concatenate([np.minimum(EVERY, n - np.arange(len(c)) * EVERY) for _, c, n in blocks])
        out = np.zeros((len(at), EVERY), np.int32)
        shift, mask = np.uint64(64 - self.top), np.uint64((1 << self.top) - 1)
        for k in range(EVERY):
            w = at >> 5
            both = words[w] << np.uint64(32) | words[np.minimum(w + 1, len(words) - 1)]
            entry = self.table[((both << (at & 31).astype(np.uint64)) >> shift & mask).astype(np.int64)]
            out[:, k] = entry >> 8
            at = at + np.where(left > k, entry & 255, 0)
        first = np.cumsum(lanes) - lanes
        return [out[a : a + m].reshape(-1)[:n] for a, m, (_, _, n) in zip(first, lanes, blocks, strict=True)]


def write_tokens(docs: DataFrame, file: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts, each followed by `end_id`, in ascending order of the document id.

    Texts are encoded where they are read; their ids, in two bytes each where that is enough, are written once (`plain`, deleted at the
    end), counted, and moved by range of the document id.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(file)
        for b in batches:
            release()
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                ids = [np.append(x, np.int32(end_id)) for x in model.encode(some.column(2))]
                held = [x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(map(len, ids), pa.int32()), pa.array(held, pa.binary())], ["_id", "_h", "_n", "_ids"])

    plain = rows.select("_id", F.xxhash64("_text").alias("_h"), "_text").mapInArrow(encode, f"_id {kind}, _h long, _n int, _ids binary")
    plain.write.option("compression", "zstd").mode("overwrite").parquet(f"{path}/plain")
    plain = spark.read.schema(plain.schema).parquet(f"{path}/plain")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            new = np.bincount(np.concatenate([_ids(x, n) for n, x in zip(b.column(0).to_pylist(), b.column(1), strict=True)]))
            if len(new) > len(total):
                new, total = total, new.astype(np.int64)
            total[: len(new)] += new
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["id", "n"])

    # At most one row for each id of the vocabulary.
    counted = plain.select("_n", "_ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counted = counted.sort_values(["n", "id"])
    ids, lengths = counted["id"].to_numpy(np.int64), limited_lengths(counted["n"].to_numpy(np.int64), LONGEST)
    table = spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths, strict=True)], "id int, length int")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/code")
    code = spark.sparkContext.broadcast((ids, lengths))
    names = ["part", "block", "first", "doc_ids", "sizes", "marks", "bits"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part, block, first = Code(*code.value), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[object, np.ndarray]] = []
        size = 0
        id_type = None

        def close() -> pa.RecordBatch:
            nonlocal block, first, size
            bits, marks = made.pack(np.concatenate([x for _, x in held]).astype(np.int64))
            row = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([[i for i, _ in held]], pa.list_(id_type)), pa.array([[len(x) for _, x in held]], pa.list_(pa.int32())), pa.array([marks.astype("<u8").tobytes()], pa.binary()), pa.array([bits], pa.binary())]
            block, first, size = block + 1, first + size, 0
            held.clear()
            return pa.RecordBatch.from_arrays(row, names)

        for b in batches:
            id_type = b.column(0).type
            for i, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if held and size + n > BLOCK_IDS:
                    yield close()
                held.append((i, _ids(x, n)))
                size += n
        if held:
            yield close()

    ordered = plain.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_id", "_h").sortWithinPartitions("_id", "_h")
    blocks = ordered.select("_id", "_n", "_ids").mapInArrow(pack, f"part int, block int, first long, doc_ids array<{kind}>, sizes array<int>, marks binary, bits binary")
    blocks.write.option("compression", "zstd").mode("overwrite").parquet(f"{path}/blocks")
    drop_path(spark, f"{path}/plain")


def _ids(value: pa.BinaryScalar, n: int) -> np.ndarray:
    """The n ids of a binary value, in two or four bytes each."""
    x = value.as_buffer()
    return np.frombuffer(x, "<u2" if x.size == 2 * n else "<u4")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it), n_tokens and ids (little-endian unsigned 32-bit)."""
    return _read(spark, path, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As `read_tokens`, with ids_crc32 of those bytes in place of the ids."""
    return _read(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _read(spark: SparkSession, path: str, column: str, made, kind: pa.DataType) -> DataFrame:
    ship(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    table = spark.read.parquet(f"{path}/code").toPandas()  # at most the vocabulary
    code = spark.sparkContext.broadcast((table["id"].to_numpy(np.int64), table["length"].to_numpy(np.int64)))
    # One number for each part of the file.
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).toPandas().sort_values("part")
    before = dict(zip(sizes["part"].tolist(), (sizes["n"].cumsum() - sizes["n"]).tolist(), strict=True))
    shared = spark.sparkContext.broadcast(before)
    id_kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    name = column.split()[0]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = Code(*code.value)
        for b in batches:
            for at in range(0, b.num_rows, 16):
                some = b.slice(at, 16)
                doc_sizes = [np.array(x, np.int64) for x in some.column(4).to_pylist()]
                jobs = [(bits, np.frombuffer(marks, "<u8"), int(n.sum())) for bits, marks, n in zip(some.column(6).to_pylist(), some.column(5).to_pylist(), doc_sizes, strict=True)]
                values, starts = [], []
                for part, first, n, ids in zip(some.column(0).to_pylist(), some.column(2).to_pylist(), doc_sizes, how.unpack(jobs), strict=True):
                    end = np.cumsum(n)
                    values += [made(ids[a:z]) for a, z in zip(end - n, end, strict=True)]
                    starts.append(shared.value[part] + first + end - n)
                yield pa.RecordBatch.from_arrays([some.column(3).flatten(), pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(doc_sizes), pa.int64()), pa.array(values, kind)], ["doc_id", "start", "n_tokens", name])

    return blocks.select("part", "block", "first", "doc_ids", "sizes", "marks", "bits").mapInArrow(unpack, f"doc_id {id_kind}, start long, n_tokens long, {column}")
