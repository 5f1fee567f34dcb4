"""Stored postings against scoring of texts; shared scans; window-only rescoring."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from slotwise.operators import changes, ordering, search
from slotwise.operators.search import Rescore, SearchRequest
from slotwise.operators.term_index import asked_variants, build_index, deletions

WORDS = ["apple", "pear", "plum", "fig", "kiwi", "Été", "x1", "grape", "melon", "date"]


def texts(seed, n, start=0):
    rnd, out = random.Random(seed), []
    for i in range(start, start + n):
        size = rnd.choice([0, 1, 3, 8, 40, 200])
        words = [rnd.choice(WORDS[: rnd.randrange(1, len(WORDS))]) for _ in range(size)]
        out.append((i, rnd.choice(["a", "b", None]), " ".join(words) if size or i % 2 else None, i % 7))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(1, 600), "doc long, shelf string, body string, n int").repartition(3)


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    return build_index(docs, "doc", "body", f"file://{tmp_path_factory.mktemp('index')}/i", "shelf", block_docs=20, buckets=3)


@pytest.mark.parametrize("query", ["plum", "Fig KIWI été", "melon nothing", "nothing", "", "date date apple"])
@pytest.mark.parametrize("per_shard", [False, True])
def test_scores_are_those_of_the_texts(docs, index, query, per_shard):
    want = search.match_score(docs, "body", query, "shelf" if per_shard else None).select("doc", "shelf", "_score")
    got = index.match_score(query, per_shard).select("doc", "shard", "_score")
    assert got.count() == len({r.doc for r in got.collect()})
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    best = index.top(query, 17, per_shard).select("doc", "_score").collect()
    order = want.orderBy(F.desc("_score"), "doc").limit(17).select("doc", "_score").collect()
    assert sorted(best) == sorted(order)


def test_statistics_are_those_of_the_texts(docs, index):
    assert rows(index.term_statistics()) == rows(search.term_statistics(docs, "body"))
    shards = search.term_statistics(docs, "body", "shelf").select("shelf", "term", "doc_freq", "total_term_freq")
    assert {tuple(r) for r in index.term_statistics(per_shard=True).collect()} == {tuple(r) for r in shards.collect()}
    assert rows(index.field_statistics()) == rows(search.field_statistics(docs, "body"))


def test_ceilings_bound_all_scores_and_skip_blocks(docs, index):
    query = "fig kiwi"
    block = index._tokens(docs).select("id", "shard", "block")
    joined = index.match_score(query).withColumnRenamed("doc", "id").join(block.drop("shard"), "id")
    tops = {(r["shard"], r["block"]): r["m"] for r in joined.groupBy("shard", "block").agg(F.max("_score").alias("m")).collect()}
    ceilings = {(r["shard"], r["block"]): r["ceiling"] for r in index.ceilings(query).collect()}
    assert tops.keys() == ceilings.keys() and all(tops[b] <= ceilings[b] for b in tops)
    fifth = sorted((r["_score"] for r in index.match_score(query).collect()), reverse=True)[4]
    assert sum(c >= fifth for c in ceilings.values()) < 0.5 * len(ceilings)


def test_no_text_is_read_for_scores(index):
    for frame in (index.match_score("plum"), index.top("plum fig", 5), index.term_statistics()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "body" not in plan and "FileScan parquet" in plan


def test_versions_follow_changes(spark, docs, index, tmp_path):
    own = index.compacted(f"file://{tmp_path}/own")
    assert rows(own.match_score("plum fig").drop("shard")) == rows(index.match_score("plum fig").drop("shard"))
    table, rnd = docs, random.Random(3)
    for round_ in range(3):
        ops = []
        for seq in range(120):
            op, i = rnd.choice(["index", "delete", "update", "create"]), rnd.randrange(650)
            words = " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(30)))
            ops.append((seq, op, i, rnd.choice(["a", "b"]), words, seq))
        change = spark.createDataFrame(ops, "seq long, op string, id long, shelf string, body string, n int")
        applied = changes.apply_changes(table, change, "doc", ["shelf", "body", "n"])
        own = own.after_changes(table, applied.table, applied.outcomes)
        table = spark.createDataFrame(applied.table.collect(), docs.schema)
        assert own.version == round_ + 1
        for query in ("plum", "fig été date"):
            want = search.match_score(table, "body", query).select("doc", "_score")
            assert rows(own.match_score(query).select("doc", "_score")) == rows(want)
            top = ordering.top_docs(want, ordering.by_score("doc"), 9)
            assert rows(own.top(query, 9).select("doc", "_score")) == rows(top)
    assert rows(own.term_statistics()) == rows(search.term_statistics(table, "body"))
    assert rows(own.field_statistics()) == rows(search.field_statistics(table, "body"))
    packed = own.compacted(f"file://{tmp_path}/packed")
    assert packed.version == 0 and rows(packed.match_score("fig").drop("shard")) == rows(own.match_score("fig").drop("shard"))
    assert rows(index.match_score("plum").drop("shard")) == rows(search.match_score(docs, "body", "plum").select("doc", "_score"))


REQUESTS = [
    SearchRequest(text="body", match="plum fig", size=7, from_=2),
    SearchRequest(text="body", match="plum fig", query={"range": {"n": {"gte": 3}}}, post_filter={"term": {"shelf": "a"}}, min_score=0.3),
    SearchRequest(text="body", match="été", sort="n:desc,_score", size=9),
    SearchRequest(text="body", match="kiwi", collapse="n", size=5, aggs={"n": ("terms", {"field": "n", "size": None})}),
    SearchRequest(text="body", match="plum", rescore=Rescore("date fig", window=6, weight=2.0), size=8),
    SearchRequest(text="body", match="plum melon", shard="shelf", shard_statistics=True, size=6),
    SearchRequest(text="body", match="plum", boosts=[("t", 3.0)], size=6),
    SearchRequest(text="body", match="plum", terminate_after=4, shard="shelf", size=20),
    SearchRequest(text="body", match="plum", search_after=[0.5, 100], size=5),
    SearchRequest(text="body", match="plum", slice=search.Slice("doc", 1, 3), size=500),
]


@pytest.mark.parametrize("number", range(len(REQUESTS)))
def test_search_with_index_gives_the_same(docs, index, number):
    request, tagged = REQUESTS[number], docs.withColumn("_table", F.lit("t"))
    plain, fast = search.search(tagged, request, "doc"), search.search(tagged, request, "doc", index)
    key = lambda r: tuple(sorted(r.asDict().items(), key=str))
    assert [key(r) for r in fast.hits.collect()] == [key(r) for r in plain.hits.collect()]
    assert fast.stats.collect() == plain.stats.collect()
    for name, frame in plain.aggs.items():
        assert rows(fast.aggs[name]) == rows(frame)


def test_rescore_scores_the_window_only(docs):
    request = SearchRequest(text="body", match="plum", rescore=Rescore("fig", window=4, weight=2.0), size=10)
    got = search.search(docs, request, "doc").hits.collect()
    first = search.match_score(docs, "body", "plum").orderBy(F.desc("_score"), "doc").limit(10).collect()
    second = {r.doc: r["_score"] for r in search.match_score(docs, "body", "fig").collect()}
    want = [(r.doc, r["_score"] + (2.0 * second.get(r.doc, 0.0) if k < 4 else 0.0), k < 4) for k, r in enumerate(first)]
    want.sort(key=lambda r: (not r[2], -r[1], r[0]))
    assert [r.doc for r in got] == [r[0] for r in want]
    assert all(math.isclose(r["_score"], w[1], abs_tol=1e-9) and r["_rescored"] == w[2] for r, w in zip(got, want))


def test_slot_search_reads_its_slots_only(docs, tmp_path):
    from slotwise.operators import routing

    placed = routing.assign_slot(docs.drop("shelf"), "doc", 4, 4, method="md5")
    index = build_index(placed, "doc", "body", f"file://{tmp_path}/slots", "slot", block_docs=50)
    request = SearchRequest(text="body", match="plum fig", size=12)
    routes = ["7", "12"]
    plain = search.slot_search(placed, request, "doc", routes, 4, "md5")
    fast = search.slot_search(placed, request, "doc", routes, 4, "md5", index)
    assert [r.doc for r in fast.hits.collect()] == [r.doc for r in plain.hits.collect()]
    assert fast.stats.collect() == plain.stats.collect()
    with pytest.raises(ValueError):
        build_index(docs, "doc", "body", f"file://{tmp_path}/none").of_shards([1])


def test_shared_searches_like_single_ones(docs):
    some = [REQUESTS[0], REQUESTS[1], REQUESTS[2], REQUESTS[9], SearchRequest(query={"term": {"shelf": "b"}}, sort="n:asc", size=4)]
    some += [SearchRequest(text="body", match="nothing"), SearchRequest(text="body", match="")]
    result = search.shared_searches(docs, some, "doc", ["doc"])
    got = {}
    for r in result.hits.orderBy("search_no", "_rank").collect():
        got.setdefault(r.search_no, []).append((r.doc, r["_score"]))
    for n, request in enumerate(some):
        want = [(r.doc, r["_score"]) for r in search.search(docs, request, "doc").hits.collect()]
        assert got.get(n, []) == want
    assert [tuple(r) for r in result.outcomes.collect()] == [(n, True, None) for n in range(len(some))]


def test_shared_searches_scan_once_and_fail_apart(spark, tmp_path):
    path = f"{tmp_path}/docs"
    spark.range(1000).selectExpr("id AS doc", "id % 13 AS n", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS shelf").write.parquet(path)
    some = [
        SearchRequest(query={"term": {"shelf": "a"}}, sort="n:desc", size=3), SearchRequest(query={"term": {"no_field": 1}}),
        SearchRequest(query={"term": {"shelf": "b"}}, sort="n:asc", size=5), SearchRequest(collapse="n"),
    ]
    result = search.shared_searches(spark.read.parquet(path), some, "doc", ["doc", "n"], max_concurrent=2)
    assert [(r.search_no, r.ok, r.error) for r in result.outcomes.collect()] == [
        (0, True, None), (1, False, "AnalysisException"), (2, True, None), (3, False, "ValueError"),
    ]
    plan = result.hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan
    sizes = Counter(r.search_no for r in result.hits.collect())
    assert sizes == {0: 3, 2: 5}
    for bad in ([], [SearchRequest(collapse="n")]):
        with pytest.raises(ValueError):
            search.shared_searches(spark.read.parquet(path), bad, "doc", ["doc"])


def test_deletions(spark):
    frame = spark.createDataFrame([("abca",), ("é",), ("",)], "t string")
    got = {r.t: set(r.d) for r in frame.select("t", deletions(F.col("t"), 2).alias("d")).collect()}
    assert got == {"abca": {"abca", "bca", "aca", "aba", "abc", "ca", "ba", "bc", "aa", "ac", "ab"}, "é": {"é", ""}, "": {""}}
    assert asked_variants(spark, ["ab", "ab"], 1).count() == 3


@pytest.mark.parametrize("mode", ["missing", "popular", "always"])
def test_suggestions_by_deletions(spark, tmp_path, mode):
    rnd = random.Random(5)
    terms = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 7))) for _ in range(150)]
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(terms) for _ in range(12))) for i in range(80)], "doc long, body string")
    asked = "abab baé zzz a"
    index = build_index(docs, "doc", "body", f"file://{tmp_path}/i", buckets=4).with_variants()
    freq = Counter(t for r in docs.collect() for t in set(r.body.split()))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    want = []
    for token in asked.split():
        if mode == "missing" and token in freq:
            continue
        near = [(distance(token, t), -n, t) for t, n in freq.items() if t != token and distance(token, t) <= 2]
        near = sorted(x for x in near if mode != "popular" or -x[1] > freq.get(token, 0))[:5]
        want += [(token, t, d, -n, k) for k, (d, n, t) in enumerate(near, 1)]
    assert rows(search.term_suggest(docs, "body", asked, mode=mode)) == sorted(want)
    assert rows(search.term_suggest(None, "body", asked, mode=mode, index=index)) == sorted(want)


def test_variants_do_not_grow_with_the_length_of_terms(spark, tmp_path):
    long = "abcdefghijklmnopqrstuvwxyzabcdefghijklmn"
    docs = spark.createDataFrame([(1, long), (2, "ab"), (3, "abcdefgh")], "doc long, body string")
    index = build_index(docs, "doc", "body", f"file://{tmp_path}/i").with_variants()
    stored = spark.read.parquet(f"{tmp_path}/i/variants").groupBy("term").count().collect()
    assert all(r["count"] <= 21 for r in stored) and len(stored) == 3
    for asked, found in ((long[:-2], long), (long[2:], long), (long[:20] + long[21:], long), ("cdefgh", "abcdefgh"), ("a", "ab"), ("xy" + long[:-2], long)):
        assert found in [r.term for r in index.near_terms([asked], 2).collect()]
    assert index.near_terms([long[:-5]], 2).count() == 0


def test_changed_rows_are_made_once(spark, tmp_path):
    docs = spark.createDataFrame(texts(7, 60), "doc long, shelf string, body string, n int")
    index = build_index(docs, "doc", "body", f"file://{tmp_path}/i", "shelf", block_docs=20, buckets=3)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    table = docs.withColumn("body", F.concat("body", F.lit(" plum"))).mapInPandas(counted, docs.schema)
    later = index.replaced(docs, table)
    assert seen.value == 60
    want = search.match_score(table, "body", "plum").select("doc", "_score")
    assert rows(later.match_score("plum").select("doc", "_score")) == rows(want)
    assert rows(later.field_statistics(per_shard=True).drop("shard")) == rows(search.field_statistics(table, "body", "shelf").drop("shelf"))
