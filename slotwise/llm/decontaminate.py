"""Benchmark decontamination with a distributed positional inverted index.

Every window of a benchmark item is looked up by its rarest word. The corpus is read twice: once
to count how often the benchmark's words occur, and once to store postings (word, document,
position) of the rarest words. A posting is kept if the window's second rarest word stands at its
own, offset-adjusted place; the posting carries the words around it, on which all other words of
the window are then compared.

Before the shuffles, words are tested against bit tables of a fixed size (`FILTER_BITS`), which
are all that is broadcast: a larger benchmark fills them more, which costs time, not results. The
join of postings and windows is left to Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, id_key, packed_rows, stored
from slotwise.llm.words import LETTERS, Words, buffer_of, mixed, sliced, words_of

WINDOW = 13
FILTER_BITS = 1 << 22


def windows_of(items: DataFrame, window: int | None, id_column: str = "item_id") -> DataFrame:
    """(item, window_id, terms): runs of `window` words of each text, or the whole text where it
    is shorter or `window` is None. Nulls and texts without words give none."""

    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            words = words_of(*buffer_of(batch.column(1)), LETTERS)
            ids = batch.column(0).to_pylist()
            item, key, terms = [], [], []
            for t in range(len(words)):
                a, b = words.first[t], words.first[t + 1]
                size = min(window or b - a, b - a)
                for s in range(a, b - size + 1) if size else ():
                    found = words.hashes[s : s + size]
                    item.append(ids[t])
                    key.append(int(mixed(np.cumsum(mixed(found + np.arange(size, dtype=np.uint64))))[-1].view(np.int64)))
                    terms.append(found.view(np.int64))
            yield packed_rows(
                ["item", "window_id", "terms"], [item, key, terms], [pa.string(), pa.int64(), pa.list_(pa.int64())]
            )

    return items.select(F.col(id_column).cast("string"), "text").mapInArrow(
        split, "item string, window_id long, terms array<long>"
    )


def bit_table(keys: DataFrame) -> np.ndarray:
    """The column `key` as FILTER_BITS bits: at most that many distinct numbers reach the driver."""
    places = keys.select(F.pmod("key", F.lit(FILTER_BITS)).cast("int").alias("p")).distinct().toArrow()
    bits = np.zeros(FILTER_BITS, bool)
    bits[places.column("p").to_numpy()] = True
    return np.packbits(bits)


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


def _pair(first: np.ndarray, second: np.ndarray, distance: np.ndarray | int) -> np.ndarray:
    """A key for two words `distance` places apart."""
    return mixed(first + mixed(second + np.asarray(distance).astype(np.int64).astype(np.uint64)))


def term_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term, n): how often the words of the bit table occur in whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for _, _, words in sliced(batch.column(0), LETTERS):
                terms, n = np.unique(words.hashes[_has(shared.value, words.hashes)], return_counts=True)
                yield packed_rows(["term", "n"], [terms.view(np.int64), n], [pa.int64(), pa.int64()])

    return docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def rarest_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Per distinct window: its rarest word in the corpus and the second rarest, with offsets."""
    terms = windows.select("window_id", F.posexplode("terms").alias("at", "term"))
    counts = term_counts(docs, bit_table(terms.select(F.col("term").alias("key"))))
    placed = terms.join(counts, "term", "left").select(
        "window_id", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term").alias("t")
    )
    ordered = placed.groupBy("window_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return windows.join(
        ordered.select(
            "window_id",
            F.col("t")[0]["term"].alias("term"),
            F.col("t")[0]["at"].alias("at"),
            F.coalesce(F.get("t", F.lit(1)), F.col("t")[0]).alias("second"),
        ),
        "window_id",
    )


def _contexts(words: Words, at: np.ndarray, around: int) -> np.ndarray:
    """The hashes from `around` words before to `around` words after each place, 0 beyond the text."""
    owner = np.searchsorted(words.first, at, "right") - 1
    low, high = words.first[owner], words.first[owner + 1]
    places = at[:, None] + np.arange(-around, around + 1)
    inside = (places >= low[:, None]) & (places < high[:, None])
    return np.where(inside, words.hashes[np.clip(places, 0, len(words.hashes) - 1)], np.uint64(0))


def postings(docs: DataFrame, terms: np.ndarray, pairs: np.ndarray | None, around: int) -> DataFrame:
    """A row per document (term null, n_words) and a row per posting (term, pos, context)."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, pairs))
    names = ["doc_id", "tag", "n_words", "term", "pos", "context"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]

    def look(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, together = shared.value
        for batch in rows:
            ids, tags = batch.column(0), batch.column(1)
            for a, b, words in sliced(batch.column(2), LETTERS):
                yield packed_rows(
                    names,
                    [ids[a:b], tags[a:b], words.counts, *([[None] * (b - a)] * 3)],
                    types,
                )
                at = np.flatnonzero(_has(wanted, words.hashes))
                if together is not None and len(at):
                    found = np.zeros(len(at), bool)
                    near = _contexts(words, at, around)
                    for k in range(2 * around + 1):
                        found |= (near[:, k] != 0) & _has(together, _pair(words.hashes[at], near[:, k], k - around))
                    at = at[found]
                if len(at):
                    owner = np.searchsorted(words.first, at, "right") - 1
                    near = _contexts(words, at, around)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1) * near.shape[1], pa.int32()), pa.array(near.view(np.int64).ravel())
                    )
                    yield packed_rows(
                        names,
                        [
                            ids.take(pa.array(owner + a)), tags.take(pa.array(owner + a)), [None] * len(at),
                            words.hashes[at].view(np.int64), at - words.first[owner], lists,
                        ],
                        types,
                    )

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"), "text").mapInArrow(
        look, "doc_id long, tag long, n_words long, term long, pos int, context array<long>"
    )


def index(docs: DataFrame, items: DataFrame, window: int | None, around: int, exact: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_words, matches, items per window)."""
    batches(docs.sparkSession)
    listed = stored(windows_of(items, window), "windows")
    distinct = stored(rarest_terms(docs, listed.select("window_id", "terms").dropDuplicates(["window_id"])), "rarest")
    pairs = None
    if exact:

        def keyed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                one, two, apart = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                key = _pair(one.view(np.uint64), two.view(np.uint64), apart)
                yield packed_rows(["key"], [key.view(np.int64)], [pa.int64()])

        pairs = bit_table(
            distinct.select("term", "second.term", (F.col("second.at") - F.col("at")).cast("long").alias("apart"))
            .toDF("one", "two", "apart").mapInArrow(keyed, "key long")
        )
    found = stored(postings(docs, bit_table(distinct.select(F.col("term").alias("key"))), pairs, around), "postings")
    hits = found.where("term IS NOT NULL").drop("n_words").join(distinct, "term")
    if exact:
        whole = F.slice("context", F.lit(around + 1) - F.col("at"), F.size("terms")) == F.col("terms")
        matches = hits.where(whole).select(
            "doc_id", "tag", "window_id", (F.col("pos") - F.col("at")).alias("start"), F.size("terms").alias("words")
        )
    else:
        matches = hits.where(F.size(F.array_except("terms", "context")) == 0).select(
            "doc_id", "tag", "window_id", F.col("pos").alias("start"), F.lit(1).alias("words")
        )
    return found.where("term IS NULL").select("doc_id", "tag", "n_words"), matches, listed.select("window_id", "item").distinct()


def phrase_matches(docs: DataFrame, items: DataFrame, window: int | None = WINDOW) -> DataFrame:
    """(doc_id, item, start, words): every place where a window of an item stands word for word."""
    _, matches, links = index(docs, items, window, (window or _longest(items)) - 1, exact=True)
    return matches.join(links, "window_id").select("doc_id", "item", "start", "words").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, within: int = 20) -> DataFrame:
    """(doc_id, item, start): places of an item's rarest word that have all words of the item, in
    any order, at most `within` words away."""
    _, matches, links = index(docs, items, None, within, exact=False)
    return matches.join(links, "window_id").select("doc_id", "item", "start").distinct()


def _longest(items: DataFrame) -> int:
    longest = windows_of(items, None).agg(F.max(F.size("terms"))).first()[0]
    return max(2, longest or 0)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, tag, n_words, n_hit, items, contaminated.

    A word inside any occurrence of a window of an item is hit; `contaminated` means at least one
    hit and hits for 5 % of the words. Null and empty texts have no words and are clean. Repeated
    rows each get their row. Items without text have no window; an item without id hits words,
    but is not listed. A document of any length and an item of any length are taken whole.
    """
    rows, matches, links = index(docs, items, window, window - 1, exact=True)
    spans = matches.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set(F.struct("start", "words"))).alias("spans"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("until")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["start"] + x["words"] - F.greatest(s["until"], x["start"]))).alias("n"),
            F.greatest(s["until"], x["start"] + x["words"]).alias("until"),
        ),
    )["n"]
    listed = (
        matches.select("doc_id", "tag", "window_id").distinct().join(links, "window_id")
        .groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hit = spans.select("doc_id", "tag", covered.cast("long").alias("n_hit")).alias("s")
    hit = hit.join(listed.alias("l"), F.expr("s.doc_id <=> l.doc_id AND s.tag = l.tag"), "left").select(
        F.col("s.doc_id").alias("hit_id"), F.col("s.tag").alias("hit_tag"), "n_hit", "items"
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(hit, F.expr("doc_id <=> hit_id AND tag = hit_tag"), "left").select(
        "doc_id",
        "tag",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns."""
    bad = contamination(docs, items, window).where("contaminated").select("doc_id", "tag").distinct()
    bad = bad.select(id_key().alias("bad_id"), F.col("tag").alias("bad_tag"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    key = id_key("r.doc_id")
    same = (key == F.col("bad_id")) & (F.xxhash64("r.text") == F.col("bad_tag"))
    return rows.join(bad, same, "left_anti").select("r.*")
