"""Stored postings of a table version: relevance without reading texts.

A row of the postings holds, for one term and one block of documents, their ids, how often the term
occurs in each and how many tokens each has, with the largest frequency and the smallest length.
From these two follows the block's ceiling: no document of it can score more. The best k documents
are found in two steps: the blocks of highest ceilings give a k-th score, and of all other blocks
only those are read whose ceiling reaches it.

Blocks hold documents of like length, which sets their ceilings apart, and some `block_docs` of
them, so that a term of every document is spread over as many rows as there are blocks.

An index is a folder of Parquet tables with a directory for each version. A version holds only
what changed: postings of new rows, the ids whose older postings are void, and differences of the
statistics. Statistics are therefore exact in every version, ceilings at least as high as needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from slotwise.functions.text import TOKEN, TOKEN_SPLIT, query_tokens
from slotwise.session import stored

K1, B = 1.2, 0.75  # fixed values: BM25 saturation and length weight
SCORE_DIGITS = 6
VARIANT_EDITS = 2
#: Variants are of the first letters of a term, and as long as are left of these without two.
HEAD = 7
#: Ceilings are raised by this factor, so that rounding cannot put them below a score.
MARGIN = 1 + 1e-9


def bm25_part(tf: Column, length: Column, doc_freq: Column, docs: Column, total: Column) -> Column:
    """What a term adds to a document's score; `length` and `total` count tokens."""
    idf = F.log(1 + (docs - doc_freq + 0.5) / (doc_freq + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (length / (total / docs))))


def _length_class(text: Column) -> Column:
    """Texts of one class differ in length by less than half."""
    return F.floor(2 * F.log2(F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1.0))).cast("int")


@dataclass(frozen=True)
class TermIndex:
    """One version of an index. `shards` restricts it to some values of the shard column."""

    spark: SparkSession
    path: str
    version: int
    id_col: str
    text: str
    shard: str | None
    buckets: int
    blocks: dict[int, int]  # length class -> number of blocks
    shards: tuple | None = None

    def _table(self, name: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{name}").filter(F.col("version") <= self.version)
        return rows if self.shards is None or name == "gone" else rows.filter(F.col("shard").isin(list(self.shards)))

    def _terms(self, name: str, terms: Sequence[str]) -> DataFrame:
        """Rows of some terms: a directory for each (constants, folded before planning), within it by
        the sorted terms."""
        places = [_bucket(F.lit(t), self.buckets) for t in terms]
        return self._table(name).filter(F.col("bucket").isin(places) & F.col("term").isin(list(terms)))

    def of_shards(self, values: Sequence) -> TermIndex:
        """The index of the documents in some shards, given as values or constant expressions."""
        if self.shard is None:
            raise ValueError("the index was built without a shard column")
        return replace(self, shards=tuple(values))

    # -- statistics ---------------------------------------------------------------------

    def term_statistics(self, terms: Sequence[str] | None = None, per_shard: bool = False) -> DataFrame:
        """(term, doc_freq, total_term_freq), of all terms if none are named."""
        rows = self._table("terms") if terms is None else self._terms("terms", terms)
        group = ["shard", "term"] if per_shard else ["term"]
        sums = rows.groupBy(*group).agg(F.sum("doc_freq").alias("doc_freq"), F.sum("total_term_freq").alias("total_term_freq"))
        return sums.filter("doc_freq > 0")

    def field_statistics(self, per_shard: bool = False) -> DataFrame:
        """(max_doc, doc_count, sum_total_term_freq, sum_doc_freq)."""
        names = ("max_doc", "doc_count", "sum_total_term_freq", "sum_doc_freq")
        rows, sums = self._table("totals"), [F.sum(n).alias(n) for n in names]
        return rows.groupBy("shard").agg(*sums) if per_shard else rows.agg(*sums)

    def _figures(self, terms: list[str], per_shard: bool) -> DataFrame:
        """One row (or one per shard) `_st`: documents, tokens and the terms' frequencies."""
        totals = self.field_statistics(per_shard).select(*(["shard"] if per_shard else []), "doc_count", "sum_total_term_freq")
        freq = [F.coalesce(F.sum(F.when(F.col("term") == t, F.col("doc_freq"))), F.lit(0)).alias(f"df{i}") for i, t in enumerate(terms)]
        rows = self._terms("terms", terms)
        if per_shard:
            some = rows.groupBy("shard").agg(*freq)
            both = totals.join(some, totals["shard"].eqNullSafe(some["shard"])).drop(some["shard"])
            return both.select("shard", F.struct(*[c for c in both.columns if c != "shard"]).alias("_st"))
        some = rows.agg(F.struct(*freq).alias("f")).scalar()
        return totals.withColumn("f", some).select(F.struct("doc_count", "sum_total_term_freq", "f.*").alias("_st"))

    # -- scores -------------------------------------------------------------------------

    def _rows(self, terms: list[str], per_shard: bool) -> DataFrame:
        rows, figures = self._terms("postings", terms), self._figures(terms, per_shard)
        if per_shard:
            figures = figures.withColumnRenamed("shard", "_sh")
            return rows.join(figures, rows["shard"].eqNullSafe(figures["_sh"])).drop("_sh")
        return rows.withColumn("_st", figures.scalar())

    @staticmethod
    def _part(terms: list[str], tf: Column, length: Column) -> Column:
        freq = reduce(lambda w, i: w.when(F.col("term") == terms[i], F.col(f"_st.df{i}")), range(len(terms)), F)
        return bm25_part(tf, length, freq, F.col("_st.doc_count"), F.col("_st.sum_total_term_freq"))

    def _scored(self, rows: DataFrame, terms: list[str], among: DataFrame | None = None) -> DataFrame:
        """(id, shard, _score) of the documents in the given posting rows."""
        hit = rows.select("version", "shard", "term", "_st", F.inline("docs"))
        if among is not None:
            hit = hit.join(among.select(F.col(self.id_col).alias("id")), "id", "left_semi")
        parts = hit.withColumn("part", self._part(terms, F.col("tf"), F.col("len")))
        if self.version:
            gone = self._table("gone").groupBy("id").agg(F.max("version").alias("until"))
            parts = parts.join(gone, "id", "left").filter(F.col("until").isNull() | (F.col("until") <= F.col("version")))
        # a document has a term once, so the sum is over terms, in the order of the query
        each = [F.coalesce(F.max(F.when(F.col("term") == t, F.col("part"))), F.lit(0.0)) for t in terms]
        score = reduce(lambda a, b: a + b, each, F.lit(0.0))
        found = parts.groupBy("id").agg(F.first("shard").alias("shard"), F.round(score, SCORE_DIGITS).alias("_score"))
        return found.withColumnRenamed("id", self.id_col)

    def _nothing(self) -> DataFrame:
        return self._table("postings").select(F.inline("docs"), "shard").select(
            F.col("id").alias(self.id_col), "shard", F.lit(0.0).alias("_score")
        ).filter(F.lit(False))

    def match_score(self, query: str, per_shard: bool = False, among: DataFrame | None = None) -> DataFrame:
        """(id, shard, _score): all documents with a token of the query, scored as `search.match_score`
        does, by the statistics of all documents or of their own shard; `among` has the ids to
        be scored, if not all are."""
        terms = query_tokens(query)
        return self._scored(self._rows(terms, per_shard), terms, among) if terms else self._nothing()

    def ceilings(self, query: str, per_shard: bool = False) -> DataFrame:
        """(shard, block, ceiling, docs): what no document of a block can exceed, and how many
        documents at least have a term of the query."""
        terms = query_tokens(query)
        rows = self._rows(terms, per_shard).withColumn("c", self._part(terms, F.col("max_tf"), F.col("min_len")))
        # a block has a row of a term in each version; what one document has lies in one of them
        term = rows.groupBy("shard", "block", "term").agg(F.max("c").alias("c"), F.sum("n").alias("n"))
        return term.groupBy("shard", "block").agg(
            F.round(F.sum("c") * MARGIN, SCORE_DIGITS).alias("ceiling"), F.max("n").alias("docs")
        )

    def top(self, query: str, k: int, per_shard: bool = False, allowed: DataFrame | None = None, first: int = 8) -> DataFrame:
        """The k best of `match_score` (ties by id). `allowed` has the ids that count, if not all do.

        The `first` blocks of highest ceilings are scored for a k-th score; blocks whose ceiling
        is lower are skipped. Ceilings bound every score from above, so no hit is lost.
        """
        terms = query_tokens(query)
        if not terms or k <= 0:
            return self._nothing()
        rows, blocks = self._rows(terms, per_shard), self.ceilings(query, per_shard)
        order = [F.desc("_score"), F.col(self.id_col).asc()]

        def best(chosen: DataFrame) -> DataFrame:
            some = chosen.select(F.struct("shard", "block").alias("_b"))
            found = self._scored(rows.withColumn("_b", F.struct("shard", "block")).join(some, "_b", "left_semi"), terms, allowed)
            return found.orderBy(*order).limit(k)

        seen = best(blocks.orderBy(F.desc("ceiling"), "shard", "block").limit(first))
        least = seen.agg(F.when(F.count(F.lit(1)) == k, F.min("_score")).otherwise(float("-inf")).alias("least"))
        return best(blocks.filter(F.col("ceiling") >= least.scalar()))

    # -- spelling -----------------------------------------------------------------------

    def near_terms(self, words: Sequence[str], most: int = 2) -> DataFrame:
        """(token, term, doc_freq): terms that share a form with at most `most` letters left out with
        one of the words. Words are looked up by equality; terms `most` edits away are among them."""
        if not 0 <= most <= VARIANT_EDITS:
            raise ValueError(f"variants are stored for up to {VARIANT_EDITS} edits")
        asked = asked_variants(self.spark, words, most)
        heads = {(w, v[: HEAD - VARIANT_EDITS]) for w in dict.fromkeys(words) for v in shortened(w, most)}
        forms = sorted({v for _, v in heads})
        rows = self.spark.read.parquet(f"{self.path}/variants").filter(F.col("version") <= self.version)
        rows = rows.filter(F.col("bucket").isin([_bucket(F.lit(f), self.buckets) for f in forms]) & F.col("variant").isin(forms))
        met = rows.join(self.spark.createDataFrame(sorted(heads), "token string, variant string"), "variant").select("token", "term")
        # who shares a whole form is no further apart than all that is left out on both sides
        close = met.filter(F.levenshtein("term", "token", VARIANT_EDITS + most) >= 0).distinct()
        whole = close.withColumn("variant", F.explode(deletions(F.col("term"), VARIANT_EDITS)))
        met = whole.join(asked, ["token", "variant"], "left_semi").select("token", "term").distinct()
        return met.join(self.term_statistics(), "term").select("token", "term", "doc_freq")

    def with_variants(self) -> TermIndex:
        """Add the variants of this version's terms: their first letters without any two.

        If two terms equal each other with up to two letters left out of each, so do the beginnings of
        these forms, and what a form begins with is the head of its term without two letters."""
        mine = self._table("terms").filter(F.col("version") == self.version).select("term").distinct()
        rows = mine.select("term", F.explode(F.array_distinct(heads(F.col("term")))).alias("variant"))
        rows = rows.withColumn("bucket", _bucket(F.col("variant"), self.buckets)).withColumn("_s", F.pmod(F.xxhash64("term"), F.lit(16)))
        self._partitioned(rows.repartition("bucket", "_s").drop("_s").sortWithinPartitions("bucket", "variant"), "variants")
        return self

    # -- versions -----------------------------------------------------------------------

    def replaced(self, before: DataFrame, after: DataFrame) -> TermIndex:
        """The next version: the documents of `before` as they were go, those of `after` come."""
        later = replace(self, version=self.version + 1, shards=None)
        # what makes the two frames runs once
        columns = list(dict.fromkeys([self.id_col, *([self.shard] if self.shard else []), self.text]))
        sides = [df.select(*columns, F.lit(new).alias("_new")) for df, new in ((before, False), (after, True))]
        both = stored(reduce(DataFrame.union, sides), "replaced")
        before, after = both.filter("NOT _new").drop("_new"), both.filter("_new").drop("_new")
        ids = both.select(self.id_col).distinct()
        ids.select(F.col(self.id_col).alias("id"), F.lit(later.version).alias("version")).write.mode("append").partitionBy("version").parquet(
            f"{self.path}/gone"
        )
        later._write(after, before)
        return later

    def after_changes(self, base: DataFrame, table: DataFrame, outcomes: DataFrame) -> TermIndex:
        """The version of a changed table: only documents with an effective change are read."""
        done = outcomes.filter(F.col("result").isin("created", "updated", "deleted"))
        ids = done.select(F.col("id").alias(self.id_col)).distinct()
        return self.replaced(base.join(ids, self.id_col, "left_semi"), table.join(ids, self.id_col, "left_semi"))

    def compacted(self, path: str) -> TermIndex:
        """The same index as a first version of its own in another folder, without void postings;
        no text is read."""
        fresh = replace(self, path=path, version=0, shards=None)
        if self.version:
            alive = self._table("postings").select("version", "shard", "block", "term", "bucket", F.inline("docs"))
            gone = self._table("gone").groupBy("id").agg(F.max("version").alias("until"))
            alive = alive.join(gone, "id", "left").filter(F.col("until").isNull() | (F.col("until") <= F.col("version")))
            fresh._write_postings(alive)
        else:  # nothing is void: the rows stay as they are, and those of a split lie in one bucket
            fresh._partitioned(self._table("postings").sortWithinPartitions("bucket", "term"), "postings")
        fresh._write_terms(self._table("terms").select("shard", "term", "bucket", F.col("doc_freq").alias("s"), F.col("total_term_freq").alias("tf")))
        fresh._append(self.field_statistics(per_shard=True), "totals")
        return fresh

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.withColumn("version", F.lit(self.version)).write.mode("append").partitionBy("version").parquet(f"{self.path}/{name}")

    def _tokens(self, docs: DataFrame) -> DataFrame:
        """(id, shard, block, _t): the pieces between separators, blank ones at the ends included."""
        shard = F.col(self.shard) if self.shard else F.lit(None).cast("string")
        kind, text = _length_class(F.col(self.text)), F.col(self.text)
        counts = F.coalesce(*[F.when(kind == c, F.lit(n)) for c, n in self.blocks.items()], F.lit(1))
        place = F.pmod(F.xxhash64(self.id_col), counts).cast("int")
        return docs.select(
            F.col(self.id_col).alias("id"), shard.alias("shard"), (kind.cast("bigint") * (1 << 32) + place).alias("block"),
            F.split(F.lower(text), TOKEN_SPLIT).alias("_t"),
        )

    def _occurring(self, docs: DataFrame) -> DataFrame:
        """(id, shard, block, term, tf, len, bucket): each row's tokens, counted in the row."""
        rows = self._tokens(docs)
        fields = [rows.schema[c] for c in ("id", "shard", "block")]
        schema = StructType([*fields, *StructType.fromDDL("term string, tf int, len int").fields])
        found = rows.mapInArrow(_counter(to_arrow_schema(schema)), schema)
        return found.withColumn("bucket", _bucket(F.col("term"), self.buckets))

    def _write_postings(self, occurring: DataFrame) -> None:
        """Rows are dealt out by bucket and block, so that a frequent term is no one task's, sorted, and
        neighbours with the same term, shard and block become one row."""
        spread = occurring.withColumn("_s", F.pmod(F.xxhash64("shard", "block"), F.lit(16)))
        order = ["bucket", "term", "shard", "block"]
        rows = spread.repartition("bucket", "_s").sortWithinPartitions(*order).select(*order, "id", "tf", "len")
        keys = [rows.schema[c] for c in order]
        docs = StructType([rows.schema[c] for c in ("id", "tf", "len")])
        rest = StructType.fromDDL("max_tf int, min_len int, n long, total_tf long").fields
        schema = StructType([*keys, StructField("docs", ArrayType(docs)), *rest])
        rows = rows.mapInArrow(_gatherer(to_arrow_schema(schema), order), schema)
        self._partitioned(rows.sortWithinPartitions("bucket", "term"), "postings")

    def _partitioned(self, rows: DataFrame, name: str) -> None:
        by = ["version", "bucket"]
        rows.withColumn("version", F.lit(self.version)).write.mode("append").partitionBy(*by).parquet(f"{self.path}/{name}")

    def _write(self, docs: DataFrame, gone: DataFrame | None = None) -> None:
        """Postings of `docs`; statistics of them, less those of `gone`. Texts are taken apart once:
        all sums of terms come from the postings as written."""
        self._write_postings(self._occurring(docs))
        names = ["shard", "term", "bucket"]
        mine = self._table("postings").filter(F.col("version") == self.version)
        terms = [mine.select(*names, F.col("n").alias("s"), F.col("total_tf").alias("tf"))]
        if gone is not None:
            terms.append(self._occurring(gone).select(*names, F.lit(-1).cast("bigint").alias("s"), (-F.col("tf")).cast("bigint").alias("tf")))
        self._write_terms(reduce(DataFrame.union, terms))
        terms = self._table("terms").filter(F.col("version") == self.version)
        zero = F.lit(0).cast("bigint")
        sums = [terms.select("shard", zero.alias("d"), zero.alias("t"), F.col("total_term_freq").alias("l"), F.col("doc_freq").alias("u"))]
        for part, sign in [(docs, 1)] + ([(gone, -1)] if gone is not None else []):
            shard, text = F.col(self.shard) if self.shard else F.lit(None).cast("string"), F.col(self.text)
            s, none = F.lit(sign).cast("bigint"), F.when(text.isNotNull(), zero)
            held = F.when(F.lower(text).rlike(TOKEN), s).otherwise(zero)
            sums.append(part.select(shard.alias("shard"), s.alias("d"), held.alias("t"), none.alias("l"), none.alias("u")))
        # terms have no shard that the documents have not; theirs may have no terms
        totals = reduce(DataFrame.union, sums).groupBy("shard").agg(
            F.sum("d").alias("max_doc"), F.sum("t").alias("doc_count"), F.sum("l").alias("sum_total_term_freq"), F.sum("u").alias("sum_doc_freq"),
        )
        self._append(totals, "totals")

    def _write_terms(self, parts: DataFrame) -> None:
        """Sums of `s` and `tf` by shard and term; a bucket is several tasks' work."""
        spread = parts.withColumn("_s", F.pmod(F.xxhash64("term", "shard"), F.lit(16))).repartition("bucket", "_s")
        sums = spread.groupBy("shard", "term", "bucket", "_s").agg(F.sum("s").alias("doc_freq"), F.sum("tf").alias("total_term_freq"))
        self._partitioned(sums.drop("_s").sortWithinPartitions("bucket", "term"), "terms")


#: Tokens counted at a time.
PIECE = 1 << 18


def _counter(schema: pa.Schema):
    """(id, shard, block, _t) -> a row for each distinct token of a row, with its number there and that of
    all tokens. Some `PIECE` tokens are looked at together, or one row's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(3)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            piece = np.cumsum(sizes) // PIECE
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
            for low, high in zip(edges, edges[1:]):
                rows = batch.slice(low, high - low)
                flat = pc.list_flatten(rows.column(3))
                row = np.repeat(np.arange(high - low, dtype=np.int64), sizes[low:high])
                full = pc.greater(pc.binary_length(flat), 0)
                flat, row = flat.filter(full), row[full.to_numpy(zero_copy_only=False)]
                if not len(row):
                    continue
                words = flat.dictionary_encode()
                width = len(words.dictionary)
                found, tf = np.unique(row * width + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
                at = found // width
                own = [rows.column(i).take(pa.array(at)) for i in range(3)]
                figures = [tf, np.bincount(row, minlength=high - low)[at]]
                columns = [*own, words.dictionary.take(pa.array(found % width)), *figures]
                yield pa.RecordBatch.from_arrays([_typed(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return count


def _gatherer(schema: pa.Schema, keys: Sequence[str]):
    """Sorted (keys, id, tf, len) -> a row for each run of equal keys."""
    kind = schema.field("docs").type

    def gathered(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        tf, length = (rows[c].to_numpy() for c in ("tf", "len"))
        edges = np.append(starts, len(rows))
        one = [_typed(_whole(rows[c]), kind.value_type.field(c).type) for c in ("id", "tf", "len")]
        docs = pa.StructArray.from_arrays(one, fields=list(kind.value_type))
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), docs, type=kind)
        at = pa.array(starts)
        figures = [np.maximum.reduceat(tf, starts), np.minimum.reduceat(length, starts), np.diff(edges), np.add.reduceat(tf.astype(np.int64), starts)]
        columns = [*[_whole(rows[c]).take(at) for c in keys], lists, *figures]
        return pa.RecordBatch.from_arrays([_typed(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            starts = _starts(rows, keys)
            if len(starts) > 1:
                yield gathered(rows.slice(0, starts[-1]), starts[:-1])
            rest = rows.slice(starts[-1])  # the last run may go on
        if rest is not None:
            yield gathered(rest, np.zeros(1, np.int64))

    return gather


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Places of rows whose keys differ from those of the row before; nulls are equal."""
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        c = _whole(rows[key])
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        changed = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= changed.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _typed(values, kind: pa.DataType) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return values if values.type == kind else values.cast(kind)


def heads(term: Column) -> Column:
    """The first `HEAD` letters of a term without any two of them; a place past its end takes none."""

    def without(i: int, j: int) -> Column:
        return F.concat(F.substring(term, 1, i - 1), F.substring(term, i + 1, j - i - 1), F.substring(term, j + 1, HEAD - j))

    return F.array(*[without(i, j) for j in range(2, HEAD + 1) for i in range(1, j)])


def deletions(term: Column, most: int) -> Column:
    """The term and its forms with up to `most` letters left out, distinct."""

    def shorter(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.char_length(t), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t))))

    found = level = F.array(term)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        found = F.concat(found, level)
    return F.array_distinct(found)


def shortened(word: str, most: int) -> set[str]:
    """As `deletions`, for a word of a query."""
    found = level = {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found


def asked_variants(spark: SparkSession, words: Sequence[str], most: int) -> DataFrame:
    """(token, variant) of the words of a query."""
    rows = [(w, v) for w in dict.fromkeys(words) for v in sorted(shortened(w, most))]
    return spark.createDataFrame(rows, "token string, variant string")


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_index(
    docs: DataFrame, id_col: str, text: str, path: str, shard: str | None = None, block_docs: int = 4096, buckets: int = 16
) -> TermIndex:
    """Write the index of a table as version 0 below `path`, a folder all executors share.

    Ids are unique. `buckets` is the number of directories terms are dealt to. Blocks are cut by
    a count of documents for each length class, of which there are some 80 at most.
    """
    classes = docs.groupBy(_length_class(F.col(text)).alias("c")).count().collect()
    blocks = {r["c"]: max(1, -(-r["count"] // block_docs)) for r in classes}
    index = TermIndex(docs.sparkSession, path.rstrip("/"), 0, id_col, text, shard, buckets, blocks)
    index._write(docs)
    return index
