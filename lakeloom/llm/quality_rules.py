"""Quality rules: a bitmask ledger. Every rule is evaluated once; policies and ablations only read the stored bits.

`measure` computes the measurements of each whole text in one Arrow pass, many texts at a time: words and lines get numbers by hash,
their bytes are compared with those of the first one of that number, and a text in which they differ is measured by itself, so the
measurements are exact. `ledger` adds `failures`, a 64-bit mask with bit i set if rule i fails. A policy is a named, versioned set of
rules: a text is kept if no bit of the policy is set. `ablations` tells, for each rule of a policy, how many texts fail it, how many fail
it alone (they would be kept without it) and how many bits overlap, from the masks alone.

Defined results: a null text has no words (all measurements 0, so it fails the base rules); repeated documents are each
reported; ties do not occur; only the id and text columns are read, so other columns never clash; an empty table gives empty results. The
arrays of a very long text take some twelve times its bytes in one worker.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import buffer_of, pieces, same_spans, ship, span_hashes, word_spans

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Rules in order of their bit; a condition that holds means failure. New rules go to the end, so that stored masks stay valid.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 8 * word_chars"),
    ("repeated_lines", "n_dup_lines > 5 AND 100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("capitals", "100 * n_upper > 60 * n_letters"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a text.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "many_symbols", "short_words", "long_words"],
    "v2": [name for name, _ in RULES],
}


def mask(policy: str) -> int:
    return sum(1 << BIT[name] for name in POLICIES[policy])


def measure_text(text: str) -> tuple[int, ...]:
    """The MEASURES of one text by itself."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            often = {w for w, c in Counter(windows).items() if c > 1}
            last = -1  # the last word counted
            for i, w in enumerate(windows):
                if w in often:
                    repeated += i + 2 - max(last, i - 1)
                    last = i + 2
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = sum(map(text.count, "abcdefghijklmnopqrstuvwxyz"))
    return n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), upper, upper + lower


_BYTE = np.arange(256)
_WORD = ~np.isin(_BYTE, list(BLANKS.encode()))
_SYMBOL = np.isin(_BYTE, list(SYMBOLS.encode()))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | (_BYTE >= 97) & (_BYTE <= 122)
#: Bytes that begin a character of a word.
_CHAR = _WORD & ((_BYTE & 0xC0) != 0x80)


def numbered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span, the same for the same hash, and whether its bytes differ from those of the first span of that number."""
    n = ends - starts
    _, first, number = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    equal = n == n[first][number]
    equal[equal] = same_spans(raw, starts[equal], raw, starts[first][number][equal], n[equal])
    return number, ~equal


def measure_texts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The MEASURES of each text, one column a text."""
    rows = len(offsets) - 1
    filled = np.flatnonzero(offsets[:-1] < offsets[1:])

    def total(table: np.ndarray) -> np.ndarray:
        out = np.zeros(rows, np.int64)
        if len(filled):
            out[filled] = np.add.reduceat(table[raw], offsets[:-1][filled], dtype=np.int64)
        return out

    starts, ends, before = word_spans(raw, offsets, _WORD)
    n = np.diff(before)
    row = np.repeat(np.arange(rows), n)
    word, odd = numbered(raw, starts, ends)
    again = set(row[odd].tolist())
    repeated = np.zeros(rows, np.int64)
    at = np.flatnonzero(row[:-2] == row[2:]) if len(row) > 2 else np.empty(0, np.int64)
    if len(at):
        a, b, c, r = word[at], word[at + 1], word[at + 2], row[at]
        order = np.lexsort((c, b, a, r))
        a, b, c, r = a[order], b[order], c[order], r[order]
        same = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (c[1:] == c[:-1]) & (r[1:] == r[:-1]))
        often = at[order[np.unique(np.concatenate([same, same + 1]))]]
        cover = np.zeros(len(word), bool)
        for k in range(3):
            cover[often + k] = True
        repeated = np.bincount(row[cover], minlength=rows)
    # Lines: pieces between line ends and the bounds of texts, with a word in them.
    line_ends = np.flatnonzero(raw == 10)
    first = np.unique(np.concatenate([offsets[:-1][filled], line_ends + 1]))
    first = first[first < offsets[-1]]
    last = np.minimum(np.append(first[1:], offsets[-1]), np.append(line_ends, offsets[-1])[np.searchsorted(line_ends, first)])
    held = np.searchsorted(starts, first) < np.searchsorted(starts, last)
    first, last = first[held], last[held]
    of = np.searchsorted(offsets, first, "right") - 1
    line, odd = numbered(raw, first, last)
    again |= set(of[odd].tolist())
    lines = np.bincount(of, minlength=rows)
    different = np.unique(of * (len(line) + 1) + line) // (len(line) + 1)
    out = np.stack([n, total(_CHAR), total(_SYMBOL), lines - np.bincount(different, minlength=rows), repeated, lines, total(_UPPER), total(_LETTER)])
    for i in again:  # two different words or lines share a hash
        out[:, i] = measure_text(raw[offsets[i] : offsets[i + 1]].tobytes().decode())
    return out


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id and the MEASURES (long) of each document."""
    ship(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in pieces(np.diff(buffer_of(b.column(1))[1])):
                found = measure_texts(*buffer_of(b.column(1).slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in found)], ["_id", *MEASURES])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(rows, f"_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements and `failures`, the bits of the rules it fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, condition) in enumerate(RULES)]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measure(docs, id_col, text_col).select(F.col("_id").alias(id_col), *MEASURES, failures.alias("failures"))


def passes(policy: str, failures: Column | None = None) -> Column:
    """Whether none of the policy's rules fails."""
    return (F.col("failures") if failures is None else failures).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: n_failed, n_only (rejected by it alone) and with_others (bits of other rules that fail with it)."""
    held = rows.select(F.col("failures").bitwiseAND(F.lit(mask(policy))).alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    held = held.select("f", "n", F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << BIT[name]).cast("long").alias("bit")) for name in POLICIES[policy]])))
    failed = F.col("f").bitwiseAND(F.col("bit")) != 0
    return held.groupBy("rule", "bit").agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("f") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
        F.coalesce(F.bit_or(F.when(failed, F.col("f").bitwiseXOR(F.col("bit")))), F.lit(0)).alias("with_others"),
    )
