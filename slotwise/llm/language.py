"""Language identification by hierarchical discrimination.

A linear support vector machine for each family of languages, one versus the rest, picks the
family. Within it a machine for every two languages, one versus one, votes for one of them.
Texts are seen as counts of hashed byte sequences of one to four letters, of the whole text.

The machines are fitted on the driver from at most `PER_LANGUAGE` texts of each learned language and
`TEXTS` in all, chosen by a hash of their doc_id. Counts for these are made on the executors, and
only non-zero ones are sent and held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows
from slotwise.llm.words import LETTERS, buffer_of, mixed

PER_LANGUAGE, TEXTS, DIMENSIONS, SLICE, NONZERO = 1000, 16_000, 1 << 13, 1 << 18, 1 << 18
UNDETERMINED = "und"

#: Families by language code. A language not named here is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "semitic": ["ar", "he", "mt"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def counts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, features): a row of unit length per text, of the square roots of its counts."""
    data, offsets = buffer_of(texts)
    letters = LETTERS.table()
    letters[0x30:0x3A] = False
    row = 0
    while row < len(offsets) - 1:
        stop = min(max(int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1, row + 1), row + 200, len(offsets) - 1)
        a, b = int(offsets[row]), int(offsets[stop])
        sums = np.zeros((stop - row) * DIMENSIONS, np.float32)
        for begin in range(a, b, 4 * SLICE):  # a giant text is counted in parts that overlap by a sequence
            part = _LOWER[data[max(a, begin - 3) : min(b, begin + 4 * SLICE)]]
            head = begin - max(a, begin - 3)
            at = np.arange(len(part)) + max(a, begin - 3)
            owner = np.searchsorted(offsets[row : stop + 1], at, "right") - 1
            inside = letters[part]
            code = np.where(inside, part, 0x20).astype(np.uint64) + np.uint64(1)
            gram = np.zeros(len(part), np.uint64)
            for length in range(1, 5):
                shifted = code[: len(part) - length + 1]
                gram = gram[length > 1 :][: len(shifted)] * np.uint64(257) + shifted if length > 1 else shifted
                last = np.arange(len(gram)) + length - 1
                whole = (owner[: len(gram)] == owner[last]) & (last >= head)
                place = (mixed(gram[whole] + np.uint64(length << 40)) % np.uint64(DIMENSIONS)).astype(np.int64)
                sums += np.bincount(owner[: len(gram)][whole] * DIMENSIONS + place, minlength=len(sums)).astype(np.float32)
        rows = np.sqrt(sums.reshape(-1, DIMENSIONS))
        yield row, stop, rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        row = stop


@dataclass
class Rows:
    """Sparse rows: row r has the values value[starts[r]:starts[r + 1]] in columns at[…]."""

    at: np.ndarray
    value: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def _slices(self) -> Iterator[tuple[int, int, slice]]:
        """Runs of rows with some `NONZERO` values, which bounds what products take besides."""
        row = 0
        while row < len(self):
            stop = max(row + 1, int(np.searchsorted(self.starts, self.starts[row] + NONZERO, "right")) - 1)
            yield row, stop, slice(self.starts[row], self.starts[stop])
            row = stop

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self), np.float64)
        for a, b, part in self._slices():
            products = np.concatenate(([0.0], np.cumsum(weights[self.at[part]] * self.value[part], dtype=np.float64)))
            edges = self.starts[a : b + 1] - self.starts[a]
            out[a:b] = products[edges[1:]] - products[edges[:-1]]
        return out

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """The sum of all rows, each times its weight."""
        out = np.zeros(DIMENSIONS)
        for a, b, part in self._slices():
            own = np.repeat(weight[a:b], np.diff(self.starts[a : b + 1]))
            out += np.bincount(self.at[part], own * self.value[part], DIMENSIONS)
        return out

    def take(self, rows: np.ndarray) -> Rows:
        parts = [slice(self.starts[r], self.starts[r + 1]) for r in rows]
        starts = np.concatenate(([0], np.cumsum(np.diff(self.starts)[rows])))
        return Rows(np.concatenate([self.at[p] for p in parts]), np.concatenate([self.value[p] for p in parts]), starts)


def machine(x: Rows, side: np.ndarray, rounds: int = 200, strength: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, both sides weighing the same."""
    weight = np.where(side > 0, 0.5 / max(1, (side > 0).sum()), 0.5 / max(1, (side <= 0).sum()))
    w, bias = np.zeros(DIMENSIONS), 0.0
    old_w, old_bias = w, bias
    step = 1 / (2 * (2 + strength))  # rows have length one, the bias adds one
    for k in range(rounds):
        look, look_bias = w + (k / (k + 3)) * (w - old_w), bias + (k / (k + 3)) * (bias - old_bias)
        short = np.maximum(0, 1 - side * (x.dot(look) + look_bias)) * weight * side
        old_w, old_bias = w, bias
        w = look + step * (2 * x.sums(short) - strength * look)
        bias = look_bias + step * 2 * float(short.sum())
    return w, bias


@dataclass
class Family:
    """Languages of a family and a machine for every two of them, positive for the first."""

    languages: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, how sure that is). The language that wins most of its pairs,
        ties by the sum of its margins, then by name; as sure as its closest pair."""
        count = len(self.languages)
        if count == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = x @ self.weights + self.bias
        won = np.zeros((len(x), count))
        total, least = np.zeros((len(x), count)), np.full((len(x), count), np.inf)
        for p, (a, b) in enumerate(self.pairs):
            for one, margin in ((a, margins[:, p]), (b, -margins[:, p])):
                won[:, one] += margin > 0 if one == b else margin >= 0
                total[:, one] += margin
                least[:, one] = np.minimum(least[:, one], margin)
        first = np.where(won == won.max(1, keepdims=True), total, -np.inf).argmax(1)
        return first, 1 / (1 + np.exp(-6 * least[np.arange(len(x)), first]))


@dataclass
class Model:
    """Families with their machines, one versus the rest; for each family its languages."""

    families: list[str]
    family_weights: np.ndarray
    family_bias: np.ndarray
    members: list[Family]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        best, sure = _pick(x @ self.family_weights + self.family_bias)
        names, score = [""] * len(x), np.zeros(len(x))
        for f, family in enumerate(self.members):
            rows = np.flatnonzero(best == f)
            if len(rows):
                lang, inner = family.predict(x[rows])
                score[rows] = sure[rows] * inner
                for r, k in zip(rows, lang, strict=True):
                    names[r] = family.languages[k]
        return names, score


def _pick(margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of greatest margin, and how sure that is by its lead over the next."""
    best = margins.argmax(1)
    if margins.shape[1] == 1:
        return best, np.ones(len(best))
    two = np.sort(margins, axis=1)[:, -2:]
    return best, 1 / (1 + np.exp(-3 * (two[:, 1] - two[:, 0])))


def _stacked(fits: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    weights = np.stack([w for w, _ in fits], axis=1) if fits else np.zeros((DIMENSIONS, 0))
    return weights.astype(np.float32), np.array([b for _, b in fits], np.float32)


def trained(x: Rows, lang: np.ndarray) -> Model:
    """The machines for texts and their languages."""
    family = np.array([_FAMILY.get(n, n) for n in lang], object)
    families, members = sorted(set(family)), []
    versus_rest = [machine(x, np.where(family == f, 1.0, -1.0)) if len(families) > 1 else (np.zeros(DIMENSIONS), 0.0) for f in families]
    for f in families:
        names = sorted(set(lang[family == f]))
        pairs, fits = list(combinations(range(len(names)), 2)), []
        for a, b in pairs:
            rows = np.flatnonzero((lang == names[a]) | (lang == names[b]))
            fits.append(machine(x.take(rows), np.where(lang[rows] == names[a], 1.0, -1.0)))
        members.append(Family(names, pairs, *_stacked(fits)))
    return Model(families, *_stacked(versus_rest), members)


def drawn(known: DataFrame) -> DataFrame:
    """(lang, at, value): features of at most `PER_LANGUAGE` texts of each language, `TEXTS` in all.

    Languages are counted first; a hash of doc_id then passes half as many more ids as are
    wanted, and the exact number is taken from these, so that no window sees a whole language.
    Rows that repeat an id and a language are one text.
    """
    counts_ = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    each = max(1, min(PER_LANGUAGE, TEXTS // max(1, len(counts_))))
    rate = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(1.5 * each / n)) for lang, n in sorted(counts_.items())], F.lit(0.0))
    place = F.xxhash64("doc_id", "lang")
    few = known.where(F.pmod(place, F.lit(1 << 32)) < rate * (1 << 32))
    texts = few.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", F.struct(place, "doc_id").alias("place"), "text")

    def sparse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, x in counts(batch.column(2)):
                at = [np.flatnonzero(r) for r in x]
                features = [[p.astype(np.uint16).tobytes() for p in at], [r[p].tobytes() for r, p in zip(x, at, strict=True)]]
                types = [batch.schema.field(0).type, batch.schema.field(1).type, pa.binary(), pa.binary()]
                yield packed_rows(["lang", "place", "at", "value"], [batch.column(0)[a:b], batch.column(1)[a:b], *features], types)

    seen = texts.mapInArrow(sparse, f"lang string, place {texts.schema['place'].dataType.simpleString()}, at binary, value binary")
    order = Window.partitionBy("lang").orderBy("place")
    return seen.withColumn("r", F.row_number().over(order)).where(F.col("r") <= each).select("lang", "at", "value")


def fit(docs: DataFrame, learn: Column) -> Model | None:
    """The machines for the languages of the rows where `learn` holds; None if there are none."""
    batches(docs.sparkSession)
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = drawn(known).toArrow()
    if not rows.num_rows:
        return None
    rows = sorted(zip(*[rows[c].to_pylist() for c in ("lang", "at", "value")], strict=True))  # as they come in any order
    lang = np.array([r[0] for r in rows], object)
    at, value = [np.frombuffer(r[1], np.uint16) for r in rows], [np.frombuffer(r[2], np.float32) for r in rows]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in at])))
    return trained(Rows(np.concatenate(at), np.concatenate(value), starts), lang)


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from its whole text alone.

    A null text and one without any letter are `und` with score 0, and so is every text where no
    language was learned. Repeated rows get equal results.
    """
    batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in rows:
            named = batch.column(2).to_pylist()
            for a, b, x in counts(batch.column(1)):
                langs, score = own.predict(x) if own else ([UNDETERMINED] * (b - a), np.zeros(b - a))
                langs = [lang if ok else UNDETERMINED for lang, ok in zip(langs, named[a:b], strict=True)]
                score = np.where(named[a:b], score, 0.0).astype(np.float64)
                yield packed_rows(["doc_id", "lang_pred", "score"], [batch.column(0)[a:b], langs, score], [pa.int64(), pa.string(), pa.float64()])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), "text", letter.alias("named")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def with_language(docs: DataFrame, learn: Column) -> DataFrame:
    """The rows of `docs` in which a language was found, with all their columns; `lang` is the
    language found, whatever was stated."""
    model = fit(docs, learn)
    letter = F.col("text").rlike(r"\p{L}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, k = docs.columns.index("text"), docs.columns.index("lang")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, x in counts(batch.column(place)):
                part = batch.slice(a, b - a)
                columns = list(part.columns)
                columns[k] = pa.array(shared.value.predict(x)[0], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    if model is None:
        return docs.where(F.lit(False))
    return docs.where(letter).mapInArrow(run, docs.schema)
