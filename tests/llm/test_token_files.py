import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "\n\nx", "x\n\n y", "don't I'll 's 't", "x<|endoftext|>y <|endoftext|> z", "a <|endoftext|>  b", "a b 　 c", "a\x1c b\x1f c", "\t\tq  ", "é ñ 漢字 🎉  🎉", " lead  two", "end\n", "é%%% ab!! ×% a\r\nb\x0bc", "x" * 5000, "a\n b\n\xa0c \x85 d", "it's 'sx 'tx. '", "A1b2 3c,,d"]


def alphabet_soup(rng):
    return "".join(rng.choice(" \n\t\r  ab'sté%.!<|>\xa0 漢1") for _ in range(rng.randint(0, 60)))


def test_ids_equal_the_library():
    rng = random.Random(2)
    model = Tokenizer.from_file(FILE)
    texts = ODD + [alphabet_soup(rng) for _ in range(3000)]
    mine = token_files.Encoder(FILE)
    assert mine.by_chunk
    for _ in range(2):
        got = mine.encode(pa.array(texts))
        for t, e, ids in zip(texts, model.encode_batch(texts, add_special_tokens=False), got, strict=True):
            assert e.ids == ids.tolist(), t


@pytest.mark.parametrize("n", [1, 2, 3, 17, 300])
def test_code_lengths_are_optimal_and_decodable(n):
    rng = random.Random(n)
    counts = np.sort(np.array([rng.randint(1, 5) for _ in range(n)], np.int64))
    lengths = token_files.limited_lengths(counts, 20)
    heap = [int(c) for c in counts]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        total += x
        heapq.heappush(heap, x)
    assert int((lengths * counts).sum()) == (total if n > 1 else counts[0])
    ids = np.arange(n) * 3
    code = token_files.Code(ids, lengths)
    text = np.array([rng.choice(ids) for _ in range(1000)])
    jobs = [text, text[:1], text[:128], text[:129]]
    packed = [(*code.pack(x), len(x)) for x in jobs]
    assert all((a == b).all() for a, b in zip(code.unpack(packed), jobs, strict=True))


def test_length_limit_holds():
    counts = np.array([int(1.6**i) + 1 for i in range(60)], np.int64)
    lengths = token_files.limited_lengths(counts, 20)
    assert lengths.max() == 20 and (2.0 ** -lengths.astype(float)).sum() == 1


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    rng = random.Random(4)
    model = Tokenizer.from_file(FILE)
    texts = ODD + [alphabet_soup(rng) for _ in range(200)] + ["many words here " * 400]
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(texts)] + [(5000, None, None), (5000, None, None), (None, "null id", "y")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path = "file://" + str(tmp_path / "tokens")
    token_files.write_tokens(df, FILE, path)
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        start += len(ids)
    digests = sorted((tuple(r) for r in token_files.read_digests(spark, path).collect()), key=lambda r: r[1])
    whole = sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert digests == [w[:4] for w in want]
    assert [(*w[:3], bytes(w[3])) for w in whole] == [(*w[:3], w[4]) for w in want]


def test_empty_table(spark, tmp_path):
    path = "file://" + str(tmp_path / "none")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), FILE, path)
    assert token_files.read_digests(spark, path).collect() == []


def thue_morse(n):
    t = np.zeros(1, np.uint8)
    while len(t) < n:
        t = np.concatenate([t, 1 - t])
    return t


def test_texts_of_regular_build_do_not_share_ids():
    model, mine = Tokenizer.from_file(FILE), token_files.Encoder(FILE)
    texts = []
    for n in [2**i for i in range(4, 17)]:
        t = thue_morse(n)
        texts += [(t + 97).tobytes().decode(), (98 - t).tobytes().decode()]
    for t, ids in zip(texts, mine.encode(pa.array(texts)), strict=True):
        assert model.encode(t, add_special_tokens=False).ids == ids.tolist(), len(t)


@pytest.mark.parametrize("kinds", [1, 3, 1000])
def test_equal_hashes_never_give_equal_ids(monkeypatch, kinds):
    monkeypatch.setattr(token_files, "key_hashes", lambda keys: keys[1] % np.uint64(kinds))
    rng = random.Random(9)
    texts = [alphabet_soup(rng) for _ in range(300)]
    model, mine = Tokenizer.from_file(FILE), token_files.Encoder(FILE)
    for some in (texts[:150], texts[100:], texts):
        for t, ids in zip(some, mine.encode(pa.array(some)), strict=True):
            assert model.encode(t, add_special_tokens=False).ids == ids.tolist(), t


def test_keys_are_equal_just_for_equal_chunks():
    rng = random.Random(12)
    chunks = [bytes(rng.choice(b"\x00ab") for _ in range(rng.randint(1, token_files.SHORT))) for _ in range(3000)] + [b"a" * n for n in range(1, 33)]
    raw, n = np.frombuffer(b"".join(chunks), np.uint8), np.array([len(c) for c in chunks])
    keys = token_files.chunk_keys(raw, np.cumsum(n) - n, n)
    assert len({tuple(k) for k in keys.T.tolist()}) == len(set(chunks))
    again = token_files.chunk_keys(np.frombuffer(b"x" + b"".join(chunks) + b"tail", np.uint8), 1 + np.cumsum(n) - n, n)
    assert (again == keys).all()


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    rng = random.Random(3)
    texts = [alphabet_soup(rng) for _ in range(400)]
    model, mine = Tokenizer.from_file(FILE), token_files.Encoder(FILE)
    for at in range(0, 400, 40):
        for t, ids in zip(texts[at : at + 40], mine.encode(pa.array(texts[at : at + 40])), strict=True):
            assert model.encode(t, add_special_tokens=False).ids == ids.tolist(), t


def test_white_space_is_all_of_unicode():
    import sys

    for c in map(chr, range(sys.maxunicode + 1)):
        if not 0xD800 <= ord(c) < 0xE000 and (c.isspace() or ord(c) < 0x3100 or ord(c) % 97 == 0):
            assert token_files.white_space(np.frombuffer(c.encode(), np.uint8)).any() == c.isspace(), hex(ord(c))
