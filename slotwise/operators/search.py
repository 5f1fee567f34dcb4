"""Relevance, term statistics, suggestions, and searches put together from the parts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.text import query_tokens, tokens
from slotwise.operators import buckets, filters, ordering, routing
from slotwise.operators.term_index import SCORE_DIGITS, TermIndex, bm25_part

UNKNOWN = -1  # fixed value: a statistic a shard does not have


# ---------------------------------------------------------------------------------------
# Term statistics


def term_statistics(df: DataFrame, text: str, shard: str | None = None) -> DataFrame:
    """(term, doc_freq, total_term_freq), per shard if one is named.

    Each document's tokens are sorted inside the row, which marks one occurrence of every
    distinct token; counting marks and occurrences then is one partial aggregation, with no
    shuffle by document.
    """
    group = [shard] if shard else []
    ordered = df.select(*group, F.sort_array(tokens(F.col(text))).alias("_t"))
    marked = F.transform(
        "_t",
        lambda t, i: F.struct(
            t.alias("term"), F.when((i > 0) & (F.get("_t", i - 1) == t), 0).otherwise(1).alias("new")
        ),
    )
    words = ordered.select(*group, F.inline(marked))
    return words.groupBy(*group, "term").agg(
        F.sum("new").alias("doc_freq"), F.count(F.lit(1)).alias("total_term_freq")
    )


def field_statistics(df: DataFrame, text: str, shard: str | None = None) -> DataFrame:
    """(max_doc, doc_count, sum_total_term_freq, sum_doc_freq), one row per shard if named."""
    toks = df.select(*([shard] if shard else []), tokens(F.col(text)).alias("_t"))
    columns = [
        F.count(F.lit(1)).alias("max_doc"),
        F.count_if(F.size("_t") > 0).alias("doc_count"),
        F.sum(F.size("_t").cast("bigint")).alias("sum_total_term_freq"),
        F.sum(F.size(F.array_distinct("_t")).cast("bigint")).alias("sum_doc_freq"),
    ]
    return toks.groupBy(shard).agg(*columns) if shard else toks.agg(*columns)


def optional_sum(name: str) -> Column:
    """Sum over shards in which one unknown makes the whole unknown."""
    return F.when(F.min(name) == UNKNOWN, F.lit(UNKNOWN)).otherwise(F.sum(name)).cast("bigint")


def merge_term_statistics(parts: DataFrame) -> DataFrame:
    return parts.groupBy("term").agg(
        F.sum("doc_freq").alias("doc_freq"), optional_sum("total_term_freq").alias("total_term_freq")
    )


def merge_field_statistics(parts: DataFrame) -> DataFrame:
    return parts.agg(
        F.sum("max_doc").alias("max_doc"),
        *[optional_sum(c).alias(c) for c in ("doc_count", "sum_total_term_freq", "sum_doc_freq")],
    )


# ---------------------------------------------------------------------------------------
# Relevance


@dataclass(frozen=True)
class Figures:
    """What relevance needs to know of a corpus: `rows` has a struct `_st` with n (documents with
    tokens), len (tokens) and df0, df1, … (documents with each of `terms`), in one row or, where
    scores rest on a document's own shard, in one per shard (`_sh`)."""

    terms: tuple[str, ...]
    rows: DataFrame
    shard: str | None = None

    def added_to(self, df: DataFrame) -> DataFrame:
        if self.shard is None:
            return df.withColumn("_st", self.rows.scalar())
        # one row per shard: Spark broadcasts it while it is small
        return df.join(self.rows, df[self.shard].eqNullSafe(self.rows["_sh"])).drop("_sh")

    def score(self, terms: Sequence[str]) -> Column:
        """BM25 (6 digits) of a row with `_dl`, `_tf` (a frequency for each of `terms`) and `_st`."""
        score = F.lit(0.0)
        for i, term in enumerate(terms):
            seen = F.col(f"_st.df{self.terms.index(term)}")
            score = score + bm25_part(F.col("_tf")[i], F.col("_dl"), seen, F.col("_st.n"), F.col("_st.len"))
        return F.round(score, SCORE_DIGITS)


def _counted(terms: Sequence[str]) -> dict[str, Column]:
    """Length and frequencies of terms of a row's tokens `_t`."""

    def freq(term: str) -> Column:
        return F.size(F.filter("_t", lambda t: t == F.lit(term)))

    return {"_dl": F.size("_t"), "_tf": F.array(*[freq(t) for t in terms])}


def text_figures(df: DataFrame, text: str, terms: Sequence[str], shard: str | None = None) -> Figures:
    """Figures of a corpus for some terms, in one pass over its texts."""
    sums = [
        F.count_if(F.col("_dl") > 0).alias("n"),
        F.sum(F.col("_dl").cast("bigint")).alias("len"),
        *[F.count_if(F.col("_tf")[i] > 0).alias(f"df{i}") for i in range(len(terms))],
    ]
    group = [shard] if shard else []
    narrow = df.select(*group, tokens(F.col(text)).alias("_t")).select(*group, *[c.alias(n) for n, c in _counted(terms).items()])
    if shard is None:
        return Figures(tuple(terms), narrow.agg(*sums).select(F.struct("*").alias("_st")))
    stat = narrow.groupBy(shard).agg(*sums)
    values = F.struct(*[c for c in stat.columns if c != shard]).alias("_st")
    return Figures(tuple(terms), stat.select(F.col(shard).alias("_sh"), values), shard)


def match_score(df: DataFrame, text: str, query: str, shard: str | None = None, figures: Figures | None = None) -> DataFrame:
    """Documents sharing a token with the query, with a BM25 `_score` (6 digits).

    With `shard` the statistics are those of the document's own shard, else of all
    documents; `figures` are those of another corpus, such as the whole of which `df` is a part.
    Frequencies of the query's terms are counted inside each row, so scoring is a
    projection: only the statistics, one row (or one per shard), cross the network.
    """
    terms = query_tokens(query)
    if not terms:
        return df.withColumn("_score", F.lit(0.0)).filter(F.lit(False))
    figures = figures or text_figures(df, text, terms, shard)
    # Only rows that contain a term as text are tokenised for scoring. The exact test sits
    # in a generator: as a filter it would be pushed below and tokenise once more.
    low = F.lower(F.col(text))
    near = reduce(lambda a, b: a | b, [low.contains(t) for t in terms])
    row = F.array(F.struct(*[c.alias(n) for n, c in _counted(terms).items()]))
    hit = F.filter(row, lambda r: F.exists(r["_tf"], lambda f: f > 0))
    hits = df.filter(near).withColumn("_t", tokens(F.col(text))).select(*df.columns, F.inline(hit))
    return figures.added_to(hits).withColumn("_score", figures.score(terms)).drop("_dl", "_tf", "_st")


def boost_tables(df: DataFrame, boosts: Sequence[tuple[str, float]], score: str = "_score") -> DataFrame:
    """Multiply the score by the factor of the row's `_table`: the first entry that names
    the table counts, 1 if none does."""
    factors: dict[str, float] = {}
    for name, factor in boosts:
        factors.setdefault(name, float(factor))
    if not factors:
        return df
    literal = F.create_map(*[F.lit(x) for pair in factors.items() for x in pair])
    factor = F.coalesce(F.try_element_at(literal, F.col("_table")), F.lit(1.0))
    return df.withColumn(score, F.col(score) * factor)


def hit_stats(
    df: DataFrame,
    score: str | None = "_score",
    from_: int = 0,
    size: int = 10,
    track_total: bool = True,
    page: DataFrame | None = None,
) -> DataFrame:
    """One row: total hits (-1 if not tracked), fetched hits, max score (NaN if none). Fetched
    are the rows of `page`, if given: collapsed hits are fewer than those found."""
    best = F.max(score) if score else F.lit(None).cast("double")
    counted = df.agg(F.count(F.lit(1)).alias("n"), best.alias("m"))
    fetched = F.greatest(F.lit(0), F.least(F.lit(size), F.col("n") - from_)).cast("bigint")
    if page is not None:
        fetched = page.agg(F.count(F.lit(1)).alias("c")).scalar()
    return counted.select(
        (F.col("n") if track_total else F.lit(UNKNOWN)).cast("bigint").alias("total_hits"),
        fetched.alias("fetched_hits"),
        F.coalesce("m", F.lit(float("nan"))).alias("max_score"),
    )


def fetch_hits(docs: DataFrame, top: DataFrame, id_col: str) -> DataFrame:
    """Whole rows for the winners only. `top` is a limited frame of (id, sort values): Spark
    knows its limit and broadcasts a page of ordinary size, without a hint."""
    extra = [c for c in top.columns if c != id_col and c in docs.columns]
    return docs.drop(*extra).join(top, id_col)


# ---------------------------------------------------------------------------------------
# Collapse with inner hits


@dataclass(frozen=True)
class InnerHits:
    """Options of one named group of inner hits."""

    name: str
    size: int = 3
    from_: int = 0
    sort: str = "_score:desc"
    fields: tuple[str, ...] = ()
    collapse: str | None = None


def expand_collapsed(
    hits: DataFrame, docs: DataFrame, group: str, tie: str, specs: Sequence[InnerHits]
) -> DataFrame:
    """Attach to every collapsed hit, per spec, an array of the best documents of its group.

    `docs` are the documents of the original query after its post filter; a null group is a
    group. One pass per spec over all hits: rows are numbered within the groups that occur
    among the hits, each task keeping at most from + size rows per group before the shuffle.
    """
    groups = hits.select(F.struct(group).alias("_g"))
    out = hits.withColumn("_g", F.struct(group))
    for spec in specs:
        member = docs.withColumn("_g", F.struct(group)).join(groups, "_g", "left_semi")
        order = ordering.sort_columns(ordering.parse_sort(spec.sort), tie)
        if spec.collapse:
            best = F.row_number().over(W.partitionBy("_g", spec.collapse).orderBy(*order))
            member = member.withColumn("_b", best).filter("_b = 1").drop("_b")
        pos = F.row_number().over(W.partitionBy("_g").orderBy(*order))
        last = spec.from_ + spec.size
        page = member.withColumn("_p", pos).filter(F.col("_p") <= last).filter(F.col("_p") > spec.from_)
        fields = spec.fields or (tie,)
        inner = page.groupBy("_g").agg(
            F.array_sort(F.collect_list(F.struct("_p", *fields))).alias(spec.name)
        )
        kept = F.transform(spec.name, lambda s: F.struct(*[s[f].alias(f) for f in fields]))
        out = out.join(inner.withColumn(spec.name, kept), "_g", "left")
    return out.drop("_g")


# ---------------------------------------------------------------------------------------
# Suggestions


def term_suggest(
    df: DataFrame | None,
    text: str,
    query: str,
    size: int = 5,
    mode: str = "missing",
    max_distance: int = 2,
    index: TermIndex | None = None,
) -> DataFrame:
    """(token, suggestion, distance, doc_freq, rank) for the tokens of `query`.

    Mode `missing` suggests only for tokens no document has, `popular` only terms in more
    documents than the token, `always` without condition. Order: distance, frequency
    descending, term. Without an index distances are taken per document before anything is
    shuffled, and only close terms are: the vocabulary as a whole is never built. With an `index`
    no text is read, and candidates are found by equality: terms that, with up to `max_distance`
    letters left out, equal a token with as many left out. Distances are taken of these only.
    """
    if mode not in ("missing", "popular", "always"):
        raise ValueError(f"unknown suggest mode [{mode}]")
    asked = query_tokens(query)
    if index is not None:
        near = index.near_terms(asked, max_distance)
    else:
        words = df.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))
        close = [
            (F.abs(F.char_length("term") - len(t)) <= max_distance) & (F.levenshtein("term", F.lit(t), max_distance) >= 0)
            for t in asked
        ]
        freqs = words.filter(reduce(lambda a, b: a | b, close, F.lit(False))).groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
        pairs = F.array(*[F.lit(t) for t in asked]) if asked else F.array().cast("array<string>")
        near = freqs.withColumn("token", F.explode(pairs)).select("token", "term", "doc_freq")
    per_token = near.withColumn("distance", F.levenshtein("term", "token", max_distance)).filter("distance >= 0")
    own = F.max(F.when(F.col("distance") == 0, F.col("doc_freq"))).over(W.partitionBy("token"))
    staged = per_token.withColumn("_own", F.coalesce(own, F.lit(0))).filter("distance > 0")
    if mode == "missing":
        staged = staged.filter("_own = 0")
    elif mode == "popular":
        staged = staged.filter("doc_freq > _own")
    rank = F.row_number().over(W.partitionBy("token").orderBy("distance", F.desc("doc_freq"), "term"))
    return (
        staged.withColumn("rank", rank)
        .filter(F.col("rank") <= size)
        .select("token", F.col("term").alias("suggestion"), "distance", "doc_freq", "rank")
    )


def prefix_suggest(
    df: DataFrame, option: str, weight: str, tie: str, prefixes: dict[str, str], size: int = 5
) -> DataFrame:
    """(name, id, option, weight, rank): per suggestion name the heaviest options starting
    with its prefix, ties by option, then id."""
    named = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(p).alias("prefix")) for n, p in prefixes.items()]
    )
    col = F.col(option)
    any_prefix = reduce(lambda a, b: a | b, [col.startswith(p) for p in prefixes.values()])
    hits = (
        df.filter(any_prefix)
        .withColumn("_s", F.explode(F.filter(named, lambda s: col.startswith(s["prefix"]))))
        .select(F.col("_s.name").alias("name"), tie, option, weight)
    )
    rank = F.row_number().over(W.partitionBy("name").orderBy(F.desc(weight), option, tie))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= size)


# ---------------------------------------------------------------------------------------
# Whole searches


@dataclass
class Rescore:
    """A second match over the best `window` hits, added with `weight`."""

    match: str
    window: int = 10
    weight: float = 1.0


@dataclass
class Slice:
    """Part `index` of `count` of the documents, by a hash of `field`."""

    field: str
    index: int
    count: int
    method: str = "xxhash64"


@dataclass
class SearchRequest:
    """One search over documents; every part is optional."""

    text: str | None = None  # text column `match` scores
    match: str | None = None
    shard_statistics: bool = False  # score by the statistics of a document's own shard
    boosts: Sequence[tuple[str, float]] = ()
    rescore: Rescore | None = None
    slice: Slice | None = None
    script_fields: dict[str, str] = field(default_factory=dict)
    query: dict[str, Any] | None = None
    post_filter: dict[str, Any] | None = None
    min_score: float | None = None
    sort: str | None = None
    from_: int = 0
    size: int = 10
    collapse: str | None = None
    inner_hits: Sequence[InnerHits] = ()
    includes: Sequence[str] = ()
    excludes: Sequence[str] = ()
    search_after: Sequence[Any] | None = None
    terminate_after: int = 0
    shard: str | None = None
    track_total: bool = True
    aggs: dict[str, tuple[str, dict[str, Any]]] = field(default_factory=dict)


@dataclass
class SearchResult:
    """Lazy frames of one search: a page of hits, one row of figures, named aggregations."""

    hits: DataFrame
    stats: DataFrame
    aggs: dict[str, DataFrame]


def _check(r: SearchRequest) -> None:
    if r.terminate_after and not r.shard:
        raise ValueError("terminate_after works per shard: name the shard column")
    if r.shard_statistics and not r.shard:
        raise ValueError("statistics of shards need the shard column")
    if r.rescore and (r.sort or r.collapse or r.search_after is not None):
        raise ValueError("rescore goes with neither sort nor collapse nor search_after")
    if r.rescore and r.rescore.window <= 0:
        raise ValueError("rescore window must be positive")


def _filtered(found: DataFrame, r: SearchRequest) -> DataFrame:
    if r.slice:
        found = routing.slice_rows(found, r.slice.field, r.slice.index, r.slice.count, r.slice.method)
    return found if r.query is None else found.filter(filters.query_filter(r.query))


def search(docs: DataFrame, request: SearchRequest, tie: str, index: TermIndex | None = None) -> SearchResult:
    """A page of hits, figures and aggregations of one search.

    With an `index` of the same documents no text is read but those of the page. Where the best
    documents are asked for without own sort, collapse, boosts or paging by values, blocks of
    postings that cannot reach the page are skipped.
    """
    r = request
    _check(r)
    # statistics are those of all documents, so scoring comes before the filters
    figures = None
    if r.match is None:
        found = docs.withColumn("_score", F.lit(1.0))
    elif index is not None:
        found = docs.join(index.match_score(r.match, r.shard_statistics).drop("shard"), tie)
    else:
        shard = r.shard if r.shard_statistics else None
        if r.rescore and shard is None:  # one pass for the terms of both queries
            both = query_tokens(r.match) + query_tokens(r.rescore.match)
            figures = text_figures(docs, r.text, list(dict.fromkeys(both)))
        found = match_score(docs, r.text, r.match, shard, figures)
    found = _filtered(boost_tables(found, r.boosts), r)
    if r.min_score is not None:
        found = filters.min_score(found, r.min_score)
    if r.terminate_after:  # counts matching documents; their scores rest on all documents
        found = ordering.terminate_after(found, r.shard, tie, r.terminate_after)
    matching = found
    if r.post_filter is not None:
        found, matching = filters.post_filter(found, filters.query_filter(r.post_filter))

    keys = ordering.parse_sort(r.sort) if r.sort else [("_score", False)]
    order = ordering.sort_columns(keys, tie)
    narrow = list(dict.fromkeys([tie, "_score", *[k for k, _ in keys]]))
    ranked = found
    bare = not (r.sort or r.collapse or r.boosts or r.terminate_after or r.search_after is not None)
    if index is not None and r.match is not None and bare:
        ranked = _best_of(index, docs, r, tie)
    if r.rescore:
        ranked = _rescored(docs, ranked.select(tie, "_score"), r, tie, index, figures)
        order, narrow = ordering.rescored_order(tie), [*narrow, "_rescored"]
    if r.collapse:
        ranked = ordering.collapse(ranked, r.collapse, order)
    if r.search_after is not None:
        ranked = ranked.filter(ordering.after_values(keys, tie, r.search_after))
    # rank on the narrow columns, then fetch whole rows of the page
    top = ordering.top_docs(ranked.select(*narrow), order, r.size, r.from_)
    hits = fetch_hits(docs, top, tie)
    if r.collapse and r.inner_hits:
        hits = expand_collapsed(hits, found, r.collapse, tie, r.inner_hits)
    hits = filters.script_fields(hits, r.script_fields)
    if r.includes or r.excludes:
        keep = [*narrow, *r.script_fields, *[s.name for s in r.inner_hits]]
        hits = filters.source_fields(hits, r.includes, r.excludes, always=keep)
    return SearchResult(
        hits.orderBy(*order),
        hit_stats(found, "_score", r.from_, r.size, r.track_total, page=top),
        buckets.agg_search(matching, r.aggs),
    )


def _pool(r: SearchRequest) -> int:
    """How many of the best hits a page can need."""
    return max(r.from_ + r.size, r.rescore.window if r.rescore else 0)


def _best_of(index: TermIndex, docs: DataFrame, r: SearchRequest, tie: str) -> DataFrame:
    """(id, _score) of the best hits, from the blocks of postings that can hold them."""
    allowed = None
    if r.query is not None or r.slice or r.post_filter is not None:
        allowed = _filtered(docs, r)
        if r.post_filter is not None:
            allowed = allowed.filter(filters.query_filter(r.post_filter))
    best = index.top(r.match, _pool(r), r.shard_statistics, allowed).drop("shard")
    return best if r.min_score is None else filters.min_score(best, r.min_score)


def _rescored(
    docs: DataFrame, found: DataFrame, r: SearchRequest, tie: str, index: TermIndex | None, figures: Figures | None
) -> DataFrame:
    """The best hits, those of the window scored by the second query too. Only their texts (or
    postings) are looked at; its statistics are those of all documents."""
    best = found.orderBy(*ordering.by_score(tie)).limit(_pool(r))
    terms = query_tokens(r.rescore.match)
    if not terms:
        second = best.withColumn("_second", F.lit(0.0))
    elif index is not None:
        other = index.match_score(r.rescore.match, among=best).select(tie, F.col("_score").alias("_second"))
        second = best.join(other, tie, "left")
    else:
        figures = figures or text_figures(docs, r.text, terms)
        texts = docs.select(tie, tokens(F.col(r.text)).alias("_t")).join(best, tie)
        row = F.array(F.struct(*[c.alias(n) for n, c in _counted(terms).items()]))
        counted = figures.added_to(texts.select(tie, "_score", F.inline(row)))
        second = counted.select(tie, "_score", figures.score(terms).alias("_second"))
    # a numbering of one page
    place = F.row_number().over(W.orderBy(*ordering.by_score(tie)))
    placed = second.withColumn("_rescored", place <= r.rescore.window)
    more = F.when(F.col("_rescored"), F.coalesce("_second", F.lit(0.0)) * r.rescore.weight).otherwise(0.0)
    return placed.withColumn("_score", F.col("_score") + more).drop("_second")


@dataclass
class MultiResult:
    hits: DataFrame
    outcomes: DataFrame


def multi_search(
    spark: SparkSession, searches: Sequence[Callable[[], DataFrame]], max_concurrent: int | None = None
) -> MultiResult:
    """Several searches as one frame: rows tagged `search_no`, an outcome row per search.

    A search that cannot be analysed becomes a failure, the others are not affected. Spark
    schedules them together; the limit is only checked.
    """
    if not searches:
        raise ValueError("no searches given")
    if max_concurrent is not None and max_concurrent < 1:
        raise ValueError("concurrency must be at least 1")
    frames, outcomes = [], []
    for number, build in enumerate(searches):
        try:
            frames.append(build().withColumn("search_no", F.lit(number)))
            outcomes.append((number, True, None))
        except (PySparkException, ValueError) as failure:
            outcomes.append((number, False, type(failure).__name__))
    if not frames:
        raise ValueError("all searches failed")
    hits = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return MultiResult(hits, spark.createDataFrame(outcomes, "search_no int, ok boolean, error string"))


def shared_searches(
    docs: DataFrame, requests: Sequence[SearchRequest], tie: str, columns: Sequence[str], max_concurrent: int | None = None
) -> MultiResult:
    """Several searches from one scan: every row is tagged with the numbers of all searches it
    matches, and one row limit per number is taken in each task before the shuffle.

    `hits` has search_no, `columns`, _score and _rank (from 1, within the search). Statistics for
    the terms of all `match` parts come from one pass of their own. A search that cannot be
    analysed becomes a failure, the others are not affected. Parts that need a pass of their own
    (collapse, rescore, aggregations, paging by values, terminate_after, boosts, own shards'
    statistics) are refused: use `multi_search` for these.
    """
    if not requests:
        raise ValueError("no searches given")
    if max_concurrent is not None and max_concurrent < 1:
        raise ValueError("concurrency must be at least 1")
    able: list[tuple[int, SearchRequest, list[str]]] = []
    outcomes = []
    for number, r in enumerate(requests):
        try:
            _check_shared(r)
            conditions = [filters.query_filter(q) for q in (r.query, r.post_filter) if q is not None]
            keys = ordering.parse_sort(r.sort) if r.sort else [("_score", False)]
            fields = [F.col(k) for k, _ in keys if k != "_score"] + ([F.col(r.text)] if r.match is not None else [])
            _ = docs.select(tie, *columns, *conditions, *fields).schema  # analysed, not run
            able.append((number, r, query_tokens(r.match) if r.match is not None else []))
            outcomes.append((number, True, None))
        except (PySparkException, ValueError) as failure:
            outcomes.append((number, False, type(failure).__name__))
    if not able:
        raise ValueError("all searches failed")
    texts = {r.text for _, r, _ in able if r.match is not None}
    if len(texts) > 1:
        raise ValueError("shared searches match one text column")
    terms = list(dict.fromkeys(t for _, _, own in able for t in own))
    rows = docs
    if terms:
        text = texts.pop()
        counted = F.array(F.struct(*[c.alias(n) for n, c in _counted(terms).items()]))
        figures = text_figures(docs, text, terms)
        rows = figures.added_to(docs.withColumn("_t", tokens(F.col(text))).select(*docs.columns, F.inline(counted)))
    tags, order = [], []
    for number, r, own in able:
        score, holds = F.lit(1.0), F.lit(True)
        if r.match is not None:
            holds = reduce(lambda a, b: a | b, [F.col("_tf")[terms.index(t)] > 0 for t in own], F.lit(False))
            score = _score_of(own, terms) if own else F.lit(0.0)
        for q in (r.query, r.post_filter):
            holds = holds & filters.query_filter(q) if q is not None else holds
        if r.slice:
            holds = holds & routing.in_slice(r.slice.field, r.slice.index, r.slice.count, r.slice.method)
        holds = holds & (score >= r.min_score) if r.min_score is not None else holds
        tags.append(F.when(holds, F.struct(F.lit(number).alias("search_no"), score.alias("_score"))))
        for name, asc in ordering.parse_sort(r.sort) if r.sort else [("_score", False)]:
            key = F.when(F.col("search_no") == number, F.col(name))  # constant in other searches
            order.append(key.asc_nulls_last() if asc else key.desc_nulls_last())
    kept = list(dict.fromkeys([tie, *columns, *[k for _, r, _ in able for k, _ in ordering.parse_sort(r.sort or "") if k != "_score"]]))
    tagged = rows.select(*kept, F.inline(F.filter(F.array(*tags), lambda t: t.isNotNull())))
    rank = F.row_number().over(W.partitionBy("search_no").orderBy(*order, F.col(tie).asc()))
    most = max(r.from_ + r.size for _, r, _ in able)
    ranked = tagged.withColumn("_rank", rank).filter(F.col("_rank") <= most)
    page = reduce(
        lambda a, b: a | b,
        [(F.col("search_no") == n) & (F.col("_rank") > r.from_) & (F.col("_rank") <= r.from_ + r.size) for n, r, _ in able],
    )
    hits = ranked.filter(page).select("search_no", *columns, "_score", "_rank")
    spark = docs.sparkSession
    return MultiResult(hits, spark.createDataFrame(outcomes, "search_no int, ok boolean, error string"))


def _check_shared(r: SearchRequest) -> None:
    apart = (r.collapse, r.rescore, r.aggs, r.terminate_after, r.boosts, r.shard_statistics, r.inner_hits, r.search_after is not None)
    if any(apart):
        raise ValueError("this search needs a pass of its own")


def _score_of(own: Sequence[str], terms: Sequence[str]) -> Column:
    """The score of one search in a row with the frequencies of the terms of all."""
    parts = []
    for t in own:
        i = terms.index(t)
        parts.append(bm25_part(F.col("_tf")[i], F.col("_dl"), F.col(f"_st.df{i}"), F.col("_st.n"), F.col("_st.len")))
    return F.round(reduce(lambda a, b: a + b, parts, F.lit(0.0)), SCORE_DIGITS)


def slot_search(
    docs: DataFrame,
    request: SearchRequest,
    tie: str,
    routes: Iterable[str],
    slot_count: int,
    method: str = "xxhash64",
    index: TermIndex | None = None,
) -> SearchResult:
    """A search over the slots of the given routing values (at least one is required). An `index`
    must have the column `slot` as its shard; only the postings of these slots are read."""
    values = routing.require_routing(routes)
    pruned = routing.slot_prune(docs, values, slot_count, method)
    if index is not None:
        index = index.of_shards([routing.slot_of(F.lit(v), slot_count, method) for v in values])
    return search(pruned, request, tie, index)
