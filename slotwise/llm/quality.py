"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line is seen through shares of kinds of characters and of
words, its repetition and its length, and through the same values of the lines before and after
it. Forward and backward passes give each line's probability of being good; a document's score is
their mean, weighted by the lines' lengths.

Only documents are labelled, so in fitting each line takes its document's label. The field is
fitted on the driver from at most `SAMPLE` documents of each label, drawn by a hash of their
doc_id; longer ones are cut into chains of `CHAIN` lines there, all of which are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows
from slotwise.llm.words import VISIBLE, Words, sliced

SAMPLE, CHAIN, BINS = 1000, 64, 8

_KINDS = np.zeros(256, np.uint8)  # 1 small letter, 2 capital, 3 digit, 4 sentence mark, 5 other sign
_KINDS[0x61:0x7B] = 1
_KINDS[0x80:] = 1
_KINDS[0x41:0x5B] = 2
_KINDS[0x30:0x3A] = 3
for _b in range(0x21, 0x7F):
    if not _KINDS[_b]:
        _KINDS[_b] = 4 if chr(_b) in ".,;:?'\"()-" else 5


def lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, length in bytes, values) of every line of a slice; an empty text is one empty line."""
    breaks = np.flatnonzero(words.data == 0x0A)
    bounds = np.concatenate((words.first, np.searchsorted(words.starts, breaks)))
    # Lines as runs of words: a break belongs to the text whose words lie around it.
    cut = np.unique(bounds)
    opens = cut[:-1]
    text = np.searchsorted(words.first, opens, "right") - 1
    empty = np.flatnonzero(words.counts == 0)
    if not len(opens):
        return empty, np.zeros(len(empty), np.int64), np.zeros((len(empty), WIDTH))
    line = np.repeat(np.arange(len(opens)), np.diff(cut))
    n = np.maximum(1, np.diff(cut)).astype(float)
    begin, end = words.starts[opens], words.ends[cut[1:] - 1]
    size = end - begin

    kinds = _KINDS[words.data]
    shares = []
    for kind in range(1, 6):
        sums = np.concatenate(([0], np.cumsum(kinds == kind)))
        shares.append((sums[end] - sums[begin]) / np.maximum(1, size))
    length = words.ends - words.starts
    hashes = words.hashes
    per = lambda mask: np.bincount(line, weights=mask, minlength=len(opens)) / n
    order = np.lexsort((hashes, line))
    again = np.zeros(len(hashes))
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (line[order[1:]] == line[order[:-1]])
    next_same = np.zeros(len(hashes))
    next_same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    last = kinds[words.ends - 1]
    values = np.column_stack([
        *shares, per(length), per(again), per(next_same), per(last == 5), per(last == 4),
        per((kinds[words.starts] == 5) & (length <= 2)), per(kinds[words.starts] == 2),
        last[cut[1:] - 1] == 4, last[cut[1:] - 1] == 5, np.log1p(n), np.log1p(size),
    ])
    if len(empty):
        text = np.concatenate((text, empty))
        turn = np.argsort(text, kind="stable")
        text, size = text[turn], np.concatenate((size, np.zeros(len(empty), np.int64)))[turn]
        values = np.concatenate((values, np.zeros((len(empty), WIDTH))))[turn]
    return text, size, values


WIDTH = 16


def _around(text: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of a line, of its neighbours, and whether it has these."""
    same = text[1:] == text[:-1]
    before, after = np.zeros((len(text), 1)), np.zeros((len(text), 1))
    before[1:, 0], after[:-1, 0] = same, same
    return np.hstack((values, np.roll(values, 1, 0) * before, np.roll(values, -1, 0) * after, before, after))


@dataclass
class Field:
    """Bin edges of the values, weights of a line's features for `good`, and of neighbouring labels."""

    edges: np.ndarray
    weights: np.ndarray
    turns: np.ndarray

    def features(self, text: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Numbers of the features each line has: one bin per value, and one that is always there."""
        x = _around(text, values)
        bins = np.stack([np.searchsorted(self.edges[:, k], x[:, k]) for k in range(x.shape[1])], axis=1)
        return bins + np.arange(x.shape[1]) * (BINS + 1)

    def marginals(self, text: np.ndarray, values: np.ndarray) -> np.ndarray:
        return chains(self.weights[self.features(text, values)].sum(1) + self.weights[-1], text, self.turns)[0]


def chains(good: np.ndarray, chain: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good, expected numbers of pairs of neighbouring labels) of consecutive chains."""
    first = np.flatnonzero(np.diff(chain, prepend=chain[:1] - 1 if len(chain) else 0)) if len(chain) else np.zeros(0, int)
    sizes = np.diff(np.append(first, len(chain)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    live = [int(np.searchsorted(-sizes, -t)) for t in range(int(sizes.max(initial=0)))]
    node = np.exp(np.clip(np.column_stack((-good / 2, good / 2)), -30, 30))
    step = np.exp(turns)
    ahead, back = np.empty_like(node), np.ones_like(node)
    for t, n in enumerate(live):
        at = first[:n] + t
        now = node[at] if t == 0 else (ahead[at - 1] @ step) * node[at]
        ahead[at] = now / now.sum(1, keepdims=True)
    for t in range(len(live) - 2, -1, -1):
        at = first[: live[t + 1]] + t
        now = (back[at + 1] * node[at + 1]) @ step.T
        back[at] = now / now.sum(1, keepdims=True)
    both = ahead * back
    both /= both.sum(1, keepdims=True)
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    pair = ahead[inner][:, :, None] * step * (node[inner + 1] * back[inner + 1])[:, None, :]
    pair /= np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)
    return both[:, 1], pair.sum(0)


def fit_field(text: np.ndarray, values: np.ndarray, labels: np.ndarray, rounds: int = 150) -> Field:
    """Gradient steps on the penalised likelihood of the chains' labels."""
    x = _around(text, values)
    edges = np.quantile(x, np.linspace(0, 1, BINS + 2)[1:-1], axis=0)
    field = Field(edges, np.zeros(x.shape[1] * (BINS + 1) + 1), np.zeros((2, 2)))
    at = field.features(text, values)
    place = np.arange(len(text)) - np.concatenate(([0], np.maximum.accumulate(np.where(np.diff(text) != 0, np.arange(1, len(text)), 0))))
    chain = np.cumsum(np.append(True, (np.diff(text) != 0) | (place[1:] % CHAIN == 0)))
    inner = chain[1:] == chain[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][inner], labels[1:][inner]), 1)
    total = len(text)
    mean, square = [np.zeros_like(field.weights), np.zeros((2, 2))], [np.zeros_like(field.weights), np.zeros((2, 2))]
    for k in range(1, rounds + 1):
        good, pairs = chains(field.weights[at].sum(1) + field.weights[-1], chain, field.turns)
        gap = (labels - good) / total
        slope = np.append(np.bincount(at.ravel(), np.repeat(gap, at.shape[1]), len(field.weights) - 1), gap.sum())
        for i, (part, g) in enumerate(((field.weights, slope - 1e-4 * field.weights), (field.turns, (seen - pairs) / total - 1e-4 * field.turns))):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            part += 0.1 * (mean[i] / (1 - 0.9**k)) / (np.sqrt(square[i] / (1 - 0.99**k)) + 1e-8)
    return field


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Field | None:
    """The field for `labels` (doc_id, quality) of the rows where `learn` holds; None without any."""
    batches(docs.sparkSession)
    known = labels.where(learn & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    draw = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = known.withColumn("r", F.row_number().over(draw)).where(F.col("r") <= SAMPLE).select("doc_id", "quality")

    def measure(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, words in sliced(batch.column(2), VISIBLE):
                text, _, values = lines(words)
                cut = np.searchsorted(text, np.arange(b - a + 1))
                bodies = [values[x:y].astype(np.float32).tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield packed_rows(["doc_id", "quality", "values"], [batch.column(0)[a:b], batch.column(1)[a:b], bodies], [pa.int64(), pa.int32(), pa.binary()])

    # At most two labels' samples of ids: bounded, so texts need not be shuffled.
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select(F.col("doc_id").cast("long"), "quality", "text")
    rows = sample.mapInArrow(measure, "doc_id long, quality int, values binary").toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    parts = [np.frombuffer(v, np.float32).reshape(-1, WIDTH) for v in rows["values"].to_pylist()]
    sizes = [len(p) for p in parts]
    text = np.repeat(np.arange(len(parts)), sizes)
    return fit_field(text, np.concatenate(parts).astype(float), np.repeat(rows["quality"].to_numpy(), sizes))


def scored(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, score) for every row, of its whole text alone; 0.5 where nothing was learned.

    A null or empty text is scored as one empty line. Repeated rows get equal scores.
    """
    batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, words in sliced(batch.column(1), VISIBLE):
                text, size, values = lines(words)
                good = shared.value.marginals(text, values) if shared.value else np.full(len(text), 0.5)
                weight = np.maximum(size, 1e-9)
                score = np.bincount(text, good * weight, b - a) / np.bincount(text, weight, b - a)
                yield packed_rows(["doc_id", "score"], [batch.column(0)[a:b], np.clip(score, 0, 1)], [pa.int64(), pa.float64()])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
