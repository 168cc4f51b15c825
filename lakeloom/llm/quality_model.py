"""Quality classifier from weak labels: heuristic labellers vote, expectation-maximisation estimates how far each can be trusted,
and the posterior labels train a hashed linear scorer.

Labellers see whole texts and vote good (1), junk (0) or nothing (2). Most look for one symptom and say nothing without it. The counts
of all vote patterns (at most 3 ** 9, over all documents) go to the driver, where EM fits a two-class model: a class prior and, for each
labeller and class, the chances of its three votes, each with a prior worth a tenth of the documents so that a corpus without junk is
not split in two. The scorer is a logistic regression on the square roots of hashed 4-gram shares, over bytes and over byte classes, and
on the measured shares in steps. It is trained on a bounded sample: the `TRAIN_DOCS` different (id, text) of smallest hash, or all if
there are fewer, with their posterior as soft label. Such a sample is as large at every size of the table, repeats of a row do not
change it, and it does not depend on how rows are dealt out. The model scores every document.

Defined results: a null or wordless text gets no votes and no grams, so its posterior and score are the priors' (kept unless junk is
the rule); repeated documents are each reported alike; an empty table gives an empty result; only the id and text columns are
read, and `drop_junk` returns all columns of the rows it keeps. Texts are measured whole; the arrays of a very long text take some tens
of times its bytes in one worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import buffer_of, cut, keep_rows, mix, pieces, release, shared_dir, ship, span_hashes, word_spans

#: Different documents that train the scorer; hash buckets of byte grams and of class grams; steps that a measured share is divided into.
TRAIN_DOCS, BYTE_BUCKETS, CLASS_BUCKETS = 1500, 4096, 1024
STEPS = 12
GOOD, JUNK, NONE = 1, 0, 2
LABELLERS = ["symbols", "capitals", "mark_runs", "lone_marks", "repetition", "few_distinct", "stutter", "ordinary_words", "sentence_ends"]
BUCKETS = BYTE_BUCKETS + CLASS_BUCKETS + STEPS * len(LABELLERS)
#: Chances of the votes junk, good and none before any data, in junk and in good texts: of a labeller that looks for a symptom, and of one that judges all texts.
SYMPTOM = ((0.4, 0.05, 0.55), (0.02, 0.05, 0.93))
JUDGE = ((0.5, 0.2, 0.3), (0.02, 0.78, 0.2))
PRIORS = np.array([JUDGE if x in ("ordinary_words", "sentence_ends") else SYMPTOM for x in LABELLERS])
PRIOR_WEIGHT = 0.1

_ASCII = np.arange(256)
_BLANK = np.isin(_ASCII, [9, 10, 11, 12, 13, 32])
_SYMBOL = np.isin(_ASCII, list(b"#*$%&|<>"))
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_HIGH = _ASCII >= 128
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_UPPER & ~_LOWER & ~((_ASCII >= 48) & (_ASCII <= 57))
#: Byte classes: capitals, small letters and non-ASCII, digits; other bytes stand for themselves.
_CLASS = np.where(_UPPER, ord("A"), np.where(_LOWER | _HIGH, ord("a"), np.where((_ASCII >= 48) & (_ASCII <= 57), ord("0"), _ASCII))).astype(np.uint8)


def _below(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def votes_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes of all labellers, one row a text, and the step (0: none, 1 to STEPS - 1) of the share that each of them looks at."""
    starts, ends, before = word_spans(raw, offsets, ~_BLANK)
    n = np.diff(before)
    word_sum = lambda flags: (s := _below(flags))[before[1:]] - s[before[:-1]]
    byte_sum = lambda table: (s := _below(table[raw]))[offsets[1:]] - s[offsets[:-1]]
    inside = lambda table: (s := _below(table[raw]))[ends] - s[starts]
    chars = byte_sum(~_BLANK)
    letters, upper = byte_sum(_UPPER | _LOWER), byte_sum(_UPPER)
    marks = inside(_MARK)
    length = ends - starts
    last = raw[ends - 1] if len(ends) else raw[:0]
    capitals = inside(_UPPER)
    runs = word_sum(marks >= 2)
    lone = word_sum((length == marks) & (length == 1))
    ended = (marks == 1) & np.isin(last, list(b".,!?;:"))
    stops = word_sum(ended)
    plain = word_sum(((marks == 0) | ended) & (capitals <= 1) & (length > marks))
    hashes = span_hashes(raw, starts, ends)
    row = np.repeat(np.arange(len(n)), n)
    repeated = np.zeros(len(n), np.int64)
    if len(hashes) > 2:
        three = mix(hashes[:-2] + mix(hashes[1:-1] + mix(hashes[2:])))
        valid = row[:-2] == row[2:]
        key = mix(three + row[:-2].astype(np.uint64))[valid]
        _, where, times = np.unique(key, return_inverse=True, return_counts=True)
        repeated = np.bincount(row[:-2][valid][times[where] > 1], minlength=len(n))

    stutter = word_sum(np.append(False, (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1]))) if len(hashes) else n * 0
    distinct = np.bincount(row[np.unique(mix(hashes) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]], minlength=len(n))

    def vote(good: np.ndarray, junk: np.ndarray, sure: np.ndarray) -> np.ndarray:
        return np.where(~sure, NONE, np.where(junk, JUNK, np.where(good, GOOD, NONE)))

    some, never = n > 0, np.zeros(len(n), bool)
    symbols = byte_sum(_SYMBOL)
    shares = [(symbols, chars), (upper, letters), (runs, n), (lone, n), (repeated, n), (distinct, n), (stutter, n), (plain, n), (stops, n)]
    steps = np.stack([np.minimum(STEPS - 1, np.where(a > 0, 1 + (STEPS - 2) * a // np.maximum(b, 1), 0)) for a, b in shares], axis=1)
    votes = np.stack(
        [
            vote(never, 100 * symbols > 6 * chars, some),
            vote(never, 2 * upper > letters, letters >= 20),
            vote(never, 5 * runs > n, some),
            vote(never, 10 * lone > n, some),
            vote(never, 2 * repeated > n, n >= 20),
            vote(never, 5 * distinct < n, n >= 20),
            vote(never, 5 * stutter > n, n >= 10),
            vote(10 * plain > 8 * n, 10 * plain < 5 * n, some),
            vote((50 * stops >= n) & (2 * stops <= n), 100 * stops < n, n >= 20),
        ],
        axis=1,
    )
    return votes, steps


def fit_accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: (chance of class 0 and 1, chances [labeller, class, vote])."""
    k = patterns.shape[1]
    prior = PRIORS[:k]
    classes, chances = np.array([0.2, 0.8]), prior.copy()
    weight = PRIOR_WEIGHT * max(1, counts.sum())
    one = np.eye(3)[patterns]  # pattern, labeller, vote
    for _ in range(rounds):
        good = posterior(patterns, classes, chances)
        share = np.stack([1 - good, good], 1) * counts[:, None]
        new = np.einsum("pc,pkv->kcv", share, one) + weight * prior
        new /= new.sum(2, keepdims=True)
        total = share.sum(0) + weight * np.array([0.2, 0.8])
        done = np.abs(new - chances).max() < 1e-7
        classes, chances = total / total.sum(), new
        if done:
            break
    return classes, chances


def posterior(patterns: np.ndarray, classes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Chance of the good class for each vote pattern."""
    log = np.log(classes)[None, :] + sum(np.log(chances[j][:, patterns[:, j]]).T for j in range(patterns.shape[1]))
    return 1 / (1 + np.exp(np.clip(log[:, JUNK] - log[:, GOOD], -700, 700)))


def features(raw: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Square roots of the shares of one text's hashed 4-grams (byte grams, then class grams), and a flag for the step of each measured share."""
    out = np.zeros(BUCKETS, np.float32)
    out[BYTE_BUCKETS + CLASS_BUCKETS + STEPS * np.arange(len(steps)) + steps] = 0.5
    if len(raw) < 4:
        return out
    for table, first, size in ((raw, 0, BYTE_BUCKETS), (_CLASS[raw], BYTE_BUCKETS, CLASS_BUCKETS)):
        total = np.zeros(size, np.int64)
        for at in range(0, len(table) - 3, 1 << 20):
            x = table[at : at + (1 << 20) + 3].astype(np.uint32)
            h = (x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)) * np.uint32(0x9E3779B1)
            total += np.bincount(h >> np.uint32(33 - size.bit_length()), minlength=size)
        out[first : first + size] = np.sqrt(total / (len(raw) - 3))
    return out


def train(x: np.ndarray, good: np.ndarray, rounds: int = 200, ridge: float = 3e-4) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on soft labels (accelerated gradient descent)."""
    w, u = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    rate = np.clip(good.mean() if len(good) else 1.0, 0.01, 0.99)
    w[-1] = u[-1] = np.log(rate / (1 - rate))
    for i in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ u[:-1].astype(np.float32) + u[-1], -60, 60)))
        d = (p - good) / len(x)
        g = np.append(x.T @ d.astype(np.float32), d.sum())
        g[:-1] += ridge * u[:-1]
        new = u - g
        u = new + i / (i + 3) * (new - w)
        w = new
    return w


class Model:
    """What scoring needs: the vote model and the scorer's weights."""

    def __init__(self, classes: np.ndarray, chances: np.ndarray, weights: np.ndarray):
        self.classes, self.chances, self.weights = classes, chances, weights

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(posterior of the votes, score) of each text."""
        votes, scores = [], []
        for lo, hi in pieces(np.diff(buffer_of(column)[1])):
            raw, offsets = buffer_of(column.slice(lo, hi - lo))
            found, steps = votes_of(raw, offsets)
            votes.append(found)
            w = self.weights[:-1].astype(np.float32)
            scores += [float(features(raw[a:b], x) @ w) + self.weights[-1] for a, b, x in zip(offsets[:-1], offsets[1:], steps, strict=True)]
        patterns = np.concatenate(votes) if votes else np.empty((0, len(LABELLERS)), np.int64)
        return posterior(patterns, self.classes, self.chances), 1 / (1 + np.exp(-np.clip(np.array(scores, float), -60, 60)))


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(votes.shape[1])


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest different values, ascending."""
    return np.unique(hashes)[:k]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit the vote model on all documents and the scorer on a sample of TRAIN_DOCS different ones."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    hashed = docs.select(F.xxhash64(F.col(id_col), text).alias("h"), text.alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, least = np.zeros(3 ** len(LABELLERS), np.int64), np.empty(0, np.int64)
        for b in batches:
            release()
            least = smallest(np.concatenate([least, b.column(0).to_numpy()]), TRAIN_DOCS)
            for lo, hi in pieces(np.diff(buffer_of(b.column(1))[1])):
                total += np.bincount(_pattern(votes_of(*buffer_of(b.column(1).slice(lo, hi - lo)))[0]), minlength=len(total))
        at = np.flatnonzero(total)
        pattern = pa.array([*at.tolist(), *[None] * len(least)], pa.int32())
        yield pa.RecordBatch.from_arrays([pattern, pa.array([*[None] * len(at), *least.tolist()], pa.int64()), pa.array([*total[at].tolist(), *[0] * len(least)], pa.int64())], ["pattern", "h", "n"])

    # One pass gives both: the patterns' counts, and each task's smallest hashes, of which the smallest of all are picked.
    top = shared_dir(docs.sparkSession)
    found = cut(hashed.mapInArrow(count, "pattern int, h long, n long").groupBy("pattern", "h").agg(F.sum("n").alias("n")), top, "votes")
    counted = found.where("pattern IS NOT NULL").select("pattern", "n").toPandas().sort_values("pattern")
    patterns = counted["pattern"].to_numpy(np.int64)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    classes, chances = fit_accuracies(patterns, counted["n"].to_numpy(float))
    chosen = np.array([r["h"] for r in found.where("pattern IS NULL").select("h").orderBy("h").limit(TRAIN_DOCS).collect()], np.int64)
    if not len(chosen):
        if len(counted):
            raise RuntimeError("documents were counted, but none was sampled")
        return Model(classes, chances, train(np.empty((0, BUCKETS), np.float32), np.empty(0)))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for i, h in enumerate(b.column(0).to_pylist()):
                if h in seen or chosen[min(np.searchsorted(chosen, h), len(chosen) - 1)] != h:
                    continue
                seen.add(h)
                raw, offsets = buffer_of(b.column(1).slice(i, 1))
                votes, steps = votes_of(raw, offsets)
                yield pa.RecordBatch.from_arrays([pa.array([h], pa.int64()), pa.array(_pattern(votes), pa.int32()), pa.array([features(raw, steps[0]).tobytes()], pa.binary())], ["h", "pattern", "x"])

    picked = hashed.where(F.col("h") <= int(chosen[-1])).mapInArrow(sample, "h long, pattern int, x binary")
    rows = picked.groupBy("h").agg(F.min(F.struct("pattern", "x")).alias("r")).select("h", "r.*").toPandas().sort_values("h")  # at most TRAIN_DOCS rows
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, BUCKETS)
    votes = rows["pattern"].to_numpy(np.int64)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    return Model(classes, chances, train(x, posterior(votes, classes, chances)))


def score_quality(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, posterior (of the labellers' votes), score (of the linear scorer) and kept (score >= least)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col))
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_votes, score = model.value.score(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(by_votes), pa.array(score)], ["_id", "posterior", "score"])

    scored = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(rows, f"_id {kind}, posterior double, score double")
    return scored.select(F.col("_id").alias(id_col), "posterior", "score", (F.col("score") >= least).alias("kept"))


def drop_junk(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that the scorer keeps, with all their columns; only the fit's counts and sample are gathered."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col))
    return keep_rows(docs, text_col, lambda c: model.value.score(c)[1] >= least)
