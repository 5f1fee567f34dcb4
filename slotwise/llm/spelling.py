"""Spelling variants: words one edit apart, found by pivotal grams, and the forms they stand for.

All bigrams that occur in words are ordered by how many words have them, rare ones first. The gram
prefix of a word is its least 3 = 2 * 1 + 1 bigrams in that order (all places of the last one
included); its pivots are two of these that do not overlap, chosen by dynamic programming to be the
rarest. One edit changes bigrams that overlap, so one pivot of a word is left in every word one
edit away; and of two such words the one whose prefix ends earlier in the order has that pivot in
the other's prefix. The index holds prefixes by bigram, word length and place. Pivots are looked up
in it, shifted as an edit before or after them would shift them, and hits are verified by the
Levenshtein distance.

There are at most 90 * 90 bigrams of the letters a word can have, so that their order is broadcast.
Words, prefixes and pairs are joined by key; a crowded bigram is an equi-join that Spark can split.

Defined results: a null or empty text has no words, a null doc_id is written as an empty text when
words are damaged, repeated rows count each. Copies of a text count as often as they occur. A word
is its own root where no near word is frequent enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows, stored

GRAM, EDITS = 2, 1
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, length: int = 6) -> DataFrame:
    """(doc_id, word): the runs of at least `length` letters of every text, A to Z lower-cased."""
    long = F.filter(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)), lambda r: F.char_length(r) >= length)
    found = docs.select("doc_id", F.explode(long).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    return found.select("doc_id", low.alias("word"))


def without_letter(word: Column, at: Column) -> Column:
    """A word without its letter number `at`, from 0."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))


def vocabulary(words: DataFrame, length: int = 6, least: int = 5) -> DataFrame:
    """(word, n): words of at least `length` letters that occur `least` times or more."""
    counts = words.where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def pivots(grams: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The EDITS + 1 grams without overlap of least total weight; grams are (place, rank, weight),
    the rank being what is looked up. Dynamic programming over places and numbers of grams."""
    grams = sorted(grams)
    best: list[list[tuple[int, tuple]]] = [[(0, ())] * (len(grams) + 1)]
    for chosen in range(1, EDITS + 2):
        row: list[tuple[int, tuple]] = [(1 << 60, ())]
        for i, (place, rank, weight) in enumerate(grams):
            before = i
            while before and grams[before - 1][0] > place - GRAM:
                before -= 1
            cost, taken = best[chosen - 1][before]
            row.append(min(row[-1], (cost + weight, (*taken, (place, rank, weight)))))
        best.append(row)
    return list(best[-1][-1][1])


def _order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and number of words of every bigram; at most 8100 rows."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.array_distinct(F.transform(places, lambda i: F.substring("word", i, F.lit(GRAM))))).alias("g"))
    counts = grams.groupBy("g").count().collect()
    ordered = sorted((r["count"], r["g"]) for r in counts)
    return {g: (rank, n) for rank, (n, g) in enumerate(ordered)}


def _index(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pivots, prefixes) of all words: word, n, last (where its prefix ends), rank, size, place."""
    shared = words.sparkSession.sparkContext.broadcast(_order(words))
    names = ["word", "n", "last", "pivot", "rank", "size", "place"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32()]

    def signed(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches_in:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = [(i, *order[word[i : i + GRAM]]) for i in range(len(word) - GRAM + 1)]
                last = sorted(rank for _, rank, _ in grams)[GRAM * EDITS]
                prefix = [g for g in grams if g[1] <= last]
                out += [(word, n, last, False, rank, len(word), place) for place, rank, _ in prefix]
                out += [(word, n, last, True, rank, len(word), place) for place, rank, _ in pivots(prefix)]
            yield packed_rows(names, [list(c) for c in zip(*out, strict=True)] if out else [[]] * len(names), types)

    schema = "word string, n long, last int, pivot boolean, rank int, size int, place int"
    rows = stored(words.select("word", "n").mapInArrow(signed, schema), "grams")
    return rows.where("pivot").drop("pivot"), rows.where("NOT pivot").drop("pivot")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words exactly one edit apart. `words` has
    distinct words of at least 4 letters."""
    pivot, prefix = _index(words)
    shift = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(p).alias("place")) for s, p in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))])
    asked = pivot.withColumn("shift", F.explode(shift)).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"), "rank",
        (F.col("size") + F.col("shift.size")).alias("size"), (F.col("place") + F.col("shift.place")).alias("place"),
    )
    one = (F.col("a_last") <= F.col("last")) & (F.col("a") != F.col("word"))
    same = [asked[c] == prefix[c] for c in ("rank", "size", "place")]
    met = asked.join(prefix, [*same, one, F.levenshtein("a", "word", EDITS) == EDITS])
    pairs = met.select("a", "a_n", "word", "n")
    both = pairs.union(pairs.select("word", "n", "a", "a_n")).distinct()
    return both.toDF("word", "n", "near", "near_n")


def _roots(forms: DataFrame, depth: int) -> DataFrame:
    """(word, root) for words with a form: forms followed to the last, by doubling."""
    hops = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(max(1, depth)))):
        after = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = stored(hops.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "forms")
    return hops


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each (word, n) of `words`: `form` is the near word
    of greatest n (ties: the least) if that is at least `ratio` times the word's n, `root` the end
    of the chain of forms. Along a chain n grows by `ratio` each time, which bounds its length."""
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent as their variants")
    batches(words.sparkSession)
    words = stored(words, "words")
    pairs = near_pairs(words)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    near = stored(pairs.groupBy("word").agg(F.count("*").alias("n_near"), best), "near")
    frequent = F.col("n_near").isNotNull() & (-F.col("best.m") >= ratio * F.col("n"))
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n"),
    )
    found = stored(found, "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(found.where("form IS NOT NULL"), int(math.log(most, ratio)) + 1)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
