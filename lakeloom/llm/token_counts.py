"""Token counts: whole texts encoded in Arrow functions that return lengths only.

Texts are encoded in batches balanced by bytes. A long text is split where no piece of the vocabulary can span: before a
single space that stands between two non-spaces. There a word-boundary mark begins a new piece, and the mark that the
encoder puts before a chunk takes that space's part, so the lengths add up to the whole text's. This is checked for the
vocabulary when it is loaded (`splits_at_spaces`); for one that fails the check texts stay whole.

Defined results: null counts as the empty text (0 bytes, 0 tokens); repeated documents are each reported; only the id and
text columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import ship

#: Bytes of text given to the encoder at once, and the length beyond which a text is split.
BATCH_BYTES, LONG_BYTES = 1 << 20, 1 << 16
MARK = "▁"


@functools.lru_cache(maxsize=4)
def load(model_file: str):
    """The encoder and whether texts may be split at spaces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return model, splits_at_spaces(model)


def splits_at_spaces(model) -> bool:
    """No piece has a mark after another character, a chunk gets a mark of its own, and spaces are kept as they are."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any(MARK in p.lstrip(MARK) for p in pieces) and model.encode("a b", out_type=str) == [MARK + "a", MARK + "b"] and model.encode("a  b") != model.encode("a b")


def chunks(text: str, most: int = LONG_BYTES) -> list[str]:
    """`text` cut at single spaces between two non-space characters into chunks of about `most` characters; those spaces are left out."""
    out, start, at = [], 0, most
    while at < len(text):
        at = text.find(" ", at)
        if at < 0 or at + 1 >= len(text):
            break
        if not text[at - 1].isspace() and not text[at + 1].isspace() and MARK not in (text[at - 1], text[at + 1]):
            out.append(text[start:at])
            start = at + 1
            at = start + most
        else:
            at += 1
    return [*out, text[start:]]


def counts(rows: list[str], model_file: str) -> list[int]:
    """Tokens of each text."""
    model, split = load(model_file)
    out, held, owner, size = [0] * len(rows), [], [], 0

    def flush() -> None:
        for i, ids in zip(owner, model.encode(held, num_threads=1), strict=True):
            out[i] += len(ids)
        held.clear()
        owner.clear()

    for i, text in enumerate(rows):
        for x in chunks(text) if split and len(text) > LONG_BYTES else [text]:
            held.append(x)
            owner.append(i)
            size += len(x)
            if size >= BATCH_BYTES:
                flush()
                size = 0
    flush()
    return out


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""
    ship(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [x or "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts(rows, model_file), pa.int64())], ["_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("n_bytes"))
    df = df.mapInArrow(lengths, f"_id {kind}, n_bytes long, n_tokens long")
    return df.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
