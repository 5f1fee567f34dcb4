"""Operators against brute force on small tables with nulls, empty texts, repeats and clashing names."""

import base64
import glob
import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from slotwise.llm import bpe, chat, decontaminate, extract, language, near, quality, substrings, vectors, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, told string, n_words int"


def frame(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "k", 1, "t", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed, size=60):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    a, b = words(120, 1, 5000), words(90, 2, 5000)
    return [
        (7, " ".join(a)), (3, " ".join(a[10:60] + b)), (9, "\t".join(b[:40]) + "\n" + " ".join(a[:25])), (4, None), (5, ""),
        (6, " \n "), (8, " ".join(a)), (10, "x " * 70), (11, "short text"), (None, " ".join(b[20:70])), (12, " ".join(b) + " é ß"),
        (13, " ".join(b) + " é ß"), (13, " ".join(b) + " é ß"), (2, " ".join(words(3000, 5))),
    ]


def brute_kept(texts, n=20):
    first, out = {}, {}
    order = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in texts})
    for i, t in order:
        w = t.split()
        for s in range(len(w) - n + 1):
            first.setdefault(tuple(w[s : s + n]), (i, s))
    for i, t in order:
        w = t.split()
        gone = {p for s in range(len(w) - n + 1) if first[tuple(w[s : s + n])] < (i, s) for p in range(s, s + n)}
        out[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


def test_substrings_like_brute_force(spark, texts):
    got = substrings.without_repeats(frame(spark, texts)).select("row.*", "n_removed", "kept_sha256").collect()
    want = brute_kept(texts)
    assert len(got) == len(texts)
    for r in got:
        _, removed, kept = want[-(1 << 63) if r.doc_id is None else r.doc_id]
        assert (r.n_removed, r.text, r.kept_sha256) == (removed, kept, hashlib.sha256(kept.encode()).hexdigest())
        assert r.key == "k"
    for f in substrings.factors(frame(spark, texts)).collect():
        assert f.words >= 20 and (f.ref_doc_id or -1, f.ref_start) < (f.doc_id, f.start)


def test_kept_words_of_a_longer_slice(spark):
    many = [(i, " ".join(words(400, i % 30, 40))) for i in range(200)]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.without_repeats(frame(spark, many)).select("row.doc_id", "n_removed", "kept_sha256").collect()}
    assert got == {i: (g, hashlib.sha256(k.encode()).hexdigest()) for i, (_, g, k) in brute_kept(many).items()}


def test_drop_repeats_leaves_the_rest_of_a_text(spark):
    passage = " ".join(words(30, 3, 5000))
    rows = [
        (1, f"Head\n\n{passage}\r\n\tend  here\n"), (2, None), (3, ""), (4, " two  lines\n\nof é\t漢 \n"),
        (5, f"\tMy é  own\n\n{passage.replace(' ', chr(10))}\n \nlast\t漢\n"), (6, f"all \n{passage}\n"), (7, passage),
    ]
    got = {r.doc_id: (r.text, r.n_chars) for r in substrings.drop_repeats(frame(spark, rows)).collect()}
    want = dict(rows) | {5: "\tMy é  own\n\nlast\t漢\n", 6: "all \n\n", 7: ""}
    assert got == {i: (t, len(t or "")) for i, t in want.items()}


def brute_groups(texts, size, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[s : s + size]) for s in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}
    for a, b in combinations(sorted(x for x in sets if x is not None), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = root[a], root[b]
            root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_groups_like_brute_force(spark, texts, size, percent):
    base = words(150, 9, 5000)
    rnd = random.Random(4)
    copies = []
    for i in range(100, 160):
        w = list(base)
        for _ in range(rnd.randrange(8)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(999)}"
        copies.append((i, " ".join(w).upper() if i % 2 else " ".join(w)))
    rows = [*texts, *copies]
    got = near.near_groups(frame(spark, rows), size, percent).collect()
    want = brute_groups(rows, size, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    kept = near.one_of_each(frame(spark, rows), size, percent)
    assert kept.columns == frame(spark, rows).columns
    left = [r.doc_id for r in kept.collect()]
    assert left.count(None) == 1
    assert sorted(i for i in left if i is not None) == sorted(i for i, (_, c) in want.items() if i is not None and i == c)


def test_one_of_each_leaves_one_row_of_repeated_ones(spark):
    a, b, c = (" ".join(words(60, k, 5000)) for k in (1, 2, 3))
    rows = [(5, a), (5, a), (5, a), (7, a), (None, a), (None, a), (None, b), (None, b), (None, b + " more"), (8, c), (8, c), (9, ""), (10, None), (10, None), (None, None)]
    got = near.one_of_each(frame(spark, rows), 5, 80).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got if r.doc_id) == [(5, a), (8, c), (9, ""), (10, "")]
    unnamed = [r.text for r in got if r.doc_id is None]  # of b and its near copy one is left
    assert len(unnamed) == 2 and None in unnamed and (b in unnamed or b + " more" in unnamed)
    assert near.one_of_each(frame(spark, rows).where("false")).count() == 0


def test_near_groups_of_many_clusters_in_one_bucket(spark):
    rnd = random.Random(137)
    template = [f"c{rnd.randrange(10**6)}" for _ in range(100)]
    rows, want = [], {}
    for cluster in range(350):
        own = [f"o{rnd.randrange(10**6)}" for _ in range(40)]
        for _ in range(4):
            rows.append((len(rows), " ".join(template + own + [f"e{rnd.randrange(10**6)}" for _ in range(5)])))
        want |= brute_groups(rows[-4:], 3, 85)  # pages of two clusters share 98 of some 188 shingles
    docs = frame(spark, rows)
    bands = near.buckets(near.sketches(docs, 3).withColumnRenamed("doc_id", "rep"))
    assert bands.where("band = 0").agg(F.max("c")).first()[0] > 3 * near.PART
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_groups(docs, 3, 85).collect()}
    assert got == want


def test_decontamination(spark):
    rnd = random.Random(8)
    item = [f"q{rnd.randrange(99)}" for _ in range(30)]
    docs = [(1, "Before " + " ".join(item).upper() + " after"), (2, " ".join(item[3:15])), (3, " ".join(item[5:18]) + " pad" * 400),
            (4, None), (5, ""), (1, "Before " + " ".join(item).upper() + " after"), (None, "the end, of it"), (6, "The-End!")]
    items = spark.createDataFrame([(10, " ".join(item), 1), (9, "the end", 1), (None, "of it", 1), (7, None, 1), (8, "", 1)], "item_id long, text string, n int")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.items, r.contaminated) for r in decontaminate.contamination(frame(spark, docs), items).collect()))
    assert got == [
        (0, 4, 4, ["9"], True), (1, 32, 30, ["10"], True), (1, 32, 30, ["10"], True), (2, 12, 0, [], False), (3, 413, 13, ["10"], False),
        (4, 0, 0, [], False), (5, 0, 0, [], False), (6, 2, 2, ["9"], True),
    ]
    assert sorted(r.doc_id for r in decontaminate.decontaminate(frame(spark, docs), items).collect()) == [2, 3, 4, 5]
    places = decontaminate.phrase_matches(frame(spark, docs), items.where("item_id = 9"), None).collect()
    assert {(r.doc_id, r.start) for r in places} == {(None, 0), (6, 0)}
    assert {r.doc_id for r in decontaminate.proximity_matches(frame(spark, [(1, "end x x the"), (2, "end" + " x" * 50 + " the")]), items.where("item_id = 9"), 5).collect()} == {1}


def test_bpe_like_the_rank_files_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.RANKS, "rb"))}
    import public_tokenizers

    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    alphabet = [" ", " ", "\n", "\t", "'s", "é", "ß", "漢", "🙂", " ", "\x1c", "\x85", "a", "the", "12", "--", "<|endoftext|>", "é"]
    some = ["", " ", "  a", "a  ", *("".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(300))]
    rows = frame(spark, [*enumerate(some), (9999, None), (9999, None)])
    coded = bpe.encoded(rows, offsets=True)
    for r in coded.collect():
        text = r.row.text or ""
        assert r.ids == other.encode_ordinary(text)
        assert all(0 <= a < b <= len(text) for a, b in zip(r.starts, r.ends, strict=True))
    back = bpe.decoded(coded.select("row", "ids")).collect()
    assert all(r.text == (r.row.row.text or "") for r in back)
    ids = other.encode_ordinary("a🙂漢b")
    assert "".join(bpe.decoded_parts([[i] for i in ids])) == "a🙂漢b"
    assert {r.decoded_sha256 for r in bpe.round_trip(rows.where("text IS NULL")).collect()} == {hashlib.sha256(b"").hexdigest()}


def test_language_and_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string"))
    model = language.fit(docs, fold % 4 != 2)
    found = docs.join(language.identified(docs, model), "doc_id").where(fold % 4 == 2)
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    odd = frame(spark, [(1, None), (2, ""), (3, "123 ..."), (4, "the"), (4, "the"), (None, "the of and")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identified(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"
    assert sorted(r.doc_id or 0 for r in language.with_language(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()) == []
    none = language.identified(odd, None)
    assert {r.lang_pred for r in none.collect()} == {"und"}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    field = quality.fit(docs, labels, fold % 5 != 0)
    rows = quality.scored(docs, field).join(labels, "doc_id").where(fold % 5 == 0)
    assert rows.where("(score >= 0.3) = (quality = 1)").count() >= 0.95 * rows.count()
    scores = [r.score for r in quality.scored(odd, field).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)


def test_votes_within_a_family_like_brute_force():
    rnd = np.random.default_rng(8)
    names = ["aa", "bb", "cc", "dd"]
    pairs = list(combinations(range(4), 2))
    family = language.Family(names, pairs, rnd.normal(size=(5, len(pairs))).astype(np.float32), rnd.normal(size=len(pairs)).astype(np.float32))
    x = rnd.normal(size=(300, 5)).astype(np.float32)
    got, sure = family.predict(x)
    ties = 0
    for row, k, s in zip(x, got, sure):
        votes, sums, least = [0] * 4, [0.0] * 4, [np.inf] * 4
        for p, (a, b) in enumerate(pairs):
            margin = float(row @ family.weights[:, p] + family.bias[p])
            votes[a if margin >= 0 else b] += 1
            for i, m in ((a, margin), (b, -margin)):
                sums[i], least[i] = sums[i] + m, min(least[i], m)
        best = [i for i in range(4) if votes[i] == max(votes)]
        ties += len(best) > 1
        want = max(best, key=lambda i: sums[i])
        assert k == want and np.isclose(s, 1 / (1 + np.exp(-6 * least[want])), atol=1e-5)
    assert ties > 10
    alone = language.Family(["aa"], [], np.zeros((5, 0), np.float32), np.zeros(0, np.float32))
    assert alone.predict(x)[0].tolist() == [0] * 300


def test_languages_of_one_family_are_told_apart(spark):
    rnd = random.Random(4)
    parts = {"da": ["kob", "lun", "ejd"], "sv": ["kob", "lun", "aat"], "no": ["kob", "tis", "ejd"], "fr": ["oui", "eau"], "xx": ["zzq"]}
    rows = [(i, " ".join("".join(rnd.choice(parts[k]) for _ in range(3)) for _ in range(30)), k) for i, k in enumerate(sorted(parts) * 60)]
    rows += [(i, t, k) for i, t, k in rows[:40]] + [(None, "kobkob", "da"), (9999, "12", "da"), (9998, None, "sv")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True)))
    assert [f.languages for f in model.members] == [["da", "no", "sv"], ["fr"], ["xx"]] and len(model.members[0].pairs) == 3
    found = language.identified(docs.where("doc_id % 2 = 1"), model).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    assert found.where("lang = lang_pred OR lang_pred = 'und'").count() == found.count() > 100
    few = language.drawn(docs.where("text IS NOT NULL AND text <> '12'"))
    assert few.count() == 301  # repeated rows are one text
    again = language.with_language(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("fr")), F.col("doc_id") % 2 == 0)
    assert again.join(docs.selectExpr("doc_id AS d", "lang AS own").distinct(), F.col("doc_id") == F.col("d")).where("lang <> own").count() == 0


def test_sparse_rows_like_dense_ones():
    rnd = np.random.default_rng(3)
    dense = np.where(rnd.random((40, language.DIMENSIONS)) < 0.01, rnd.random((40, language.DIMENSIONS)), 0).astype(np.float32)
    at = [np.flatnonzero(r).astype(np.uint16) for r in dense]
    rows = language.Rows(np.concatenate(at), np.concatenate([r[p] for r, p in zip(dense, at)]), np.concatenate(([0], np.cumsum([len(p) for p in at]))))
    w, v = rnd.normal(size=language.DIMENSIONS), rnd.normal(size=40)
    assert np.allclose(rows.dot(w), dense @ w) and np.allclose(rows.sums(v), v @ dense)
    some = rows.take(np.array([3, 9, 5]))
    assert np.allclose(some.dot(w), (dense @ w)[[3, 9, 5]])


def test_chain_marginals_like_enumeration():
    rnd = np.random.default_rng(3)
    good, turns = rnd.normal(size=6), rnd.normal(size=(2, 2))
    chain = np.array([0, 0, 0, 0, 1, 1])
    total, ones = 0.0, np.zeros(4)
    for bits in range(16):
        y = [(bits >> k) & 1 for k in range(4)]
        weight = np.exp(sum(g / 2 if v else -g / 2 for g, v in zip(good, y, strict=False)) + sum(turns[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += weight
        ones += weight * np.array(y)
    assert np.allclose(quality.chains(good, chain, turns)[0][:4], ones / total)


def test_top_k_like_brute_force(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=6).tolist(), "x") for i in range(400)]
    rows += [(500 + i, [0.5] * 6, "x") for i in range(150)]
    rows += [(700, None, "x"), (701, [1.0, None], "x"), (702, [float("nan")] * 6, "x"), (None, [9.0] * 6, "x"), (703, [2.0, 1.0], "x"), (703, [2.0, 1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, norm string")
    got = {}
    for r in vectors.top(table, F.col("id") % 10 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    able = {i: np.floor(256 * np.array([*np.float32(v).astype(float), *[0.0] * (6 - len(v))])) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    for q in [i for i in able if i % 10 == 0]:
        best = sorted(((-int(able[q] @ v), i) for i, v in able.items() if i != q))[:5]
        assert got.pop(q) == {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    assert not got
    assert vectors.top(table.where("vec_id = 700"), F.lit(True)).count() == 0


def test_top_k_with_repeated_ids(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, rnd.normal(size=6).tolist()) for i in range(300)]
    rows += [(900, [4.0] * 6)] * 10 + [(901, [3.0 + j / 64] * 6) for j in range(10)]
    rows += [(902, (rnd.normal(size=6) / 99).tolist()) for _ in range(3000)]
    got, able = {}, {}
    for r in vectors.top(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 10 == 0).where("query_id < 900").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for i, v in rows:
        able.setdefault(i, []).append(np.floor(256 * np.float32(v).astype(float)))
    for q in range(0, 300, 10):
        best = sorted((-max(int(able[q][0] @ v) for v in vs), i) for i, vs in able.items() if i != q)[:5]
        assert got.pop(q) == {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    assert not got


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/ b\n", "<p>é</p>", 1), (1, "u", "<p>é</p>", 1), (2, None, None, 1), (5, "u", "", 1), (6, "u", "x" * 5000, 1), (None, "u", "x" * 5000, 1), (1, "u", "<p>é</p>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    folder = f"file://{tmp_path}/out"
    files = warc.written(pages, folder, file_bytes=300)
    assert files.count() == len(glob.glob(f"{tmp_path}/out/*.warc.gz"))
    got = warc.chunks(files, folder, chunk=999).collect()
    last = sorted((r.page_id or 0, r.upto, r.digest, r.record_type, r.refers_to) for r in got if r.last)
    name = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    p, e, x = name("<p>é</p>"), name(""), name("x" * 5000)
    assert last == [
        (0, 5000, x, "revisit", 6), (1, 9, p, "response", None), (1, 9, p, "response", None), (2, 0, e, "response", None),
        (3, 9, p, "revisit", 1), (5, 0, e, "revisit", 2), (6, 5000, x, "response", None),
    ]
    whole = b"".join(r.data or b"" for r in sorted(got, key=lambda r: r.chunk_no) if r.page_id == 6)
    assert whole == b"x" * 5000 and max(r.chunk_no for r in got) == 5
    assert warc.archived(pages.where("false")).count() == 0


PAGE = """<!doctype html><html><head><title>T</title><script>var a="</p>";</script></head><body class="comments-closed">
<header><a href=/>Home</a> Site</header><div id="main-menu"><a href=1>One</a> <a href=2>Two</a></div><div class="cookie-notice">We use cookies on this site.</div>
<{tag}><h1>A &amp; B</h1><p>First   long paragraph with <a href=x>a link</a> and more words than most, <b>indeed many.<br><p>Short.<ul><li>one<li>two</ul>
<!-- <p>gone</p> --><form>Name <input></form><p>Second long paragraph, that goes on for a while as well &lt;here&gt;.</p></{tag}>
<aside>See also this and that</aside><section class="comments"><p>A reader says that this is a long and winding comment.</p></section><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_main_text(tag):
    want = "A & B\nFirst long paragraph with a link and more words than most, indeed many.\nShort.\none\ntwo\nSecond long paragraph, that goes on for a while as well <here>."
    assert extract.main_text(PAGE.replace("{tag}", tag)) == want


LINKS = "<{0}><{1}><a href=1>Buy shoes now</a></{1}><{1}><a href=2>Ten tricks to lose weight</a></{1}><{1}><a href=3>More stories</a></{1}></{0}>"


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<body><div><div>{}</div></div>"])
def test_unmarked_lists_of_links_are_no_text(around):
    text = "Some long text of the article that goes on and on. " * 20
    for block, item in (("ul", "li"), ("div", "p"), ("table", "td")):
        page = f"<h1>Title</h1><p>{text}</p>{LINKS.format(block, item)}<p>A <a href=x>linked</a> end.</p><p><a href=y>The study</a></p>"
        want = f"Title\n{text.strip()}\nA linked end.\nThe study"
        assert extract.main_text(around.format(page)) == want


def test_names_do_not_lose_an_article():
    text = "Real text of the page. " * 30
    for page in (
        f'<body><div class="post-share-count"><p>{text}</p></div>', f'<div class="sidebar-layout"><article><p>{text}</p></article><div class="sidebar">x y</div></div>',
        f"<form><nav>menu</nav><div><p>{text}</p></div></form>", f'<div id="comments-closed"><main><p>{text}</p><div class="comments">No!</div></main></div>',
    ):
        assert extract.main_text(page) == text.strip()
    page = f'<div><h1>T</h1><p>{text}</p></div><div class="comments"><p>{text * 3}</p></div>'
    assert extract.main_text(page) == f"T\n{text.strip()}"


def brute_density(node, share, linked=False):
    """(characters, of links, tags, link tags, density, sum of the children's) by recursion; a node is
    (name, [children or texts])."""
    name, inside = node
    linked = linked or name == "a"
    chars = links = tags = link_tags = sums = 0
    for x in inside:
        if isinstance(x, str):
            size = len("".join(x.split()))
            chars, links = chars + size, links + size * linked
        else:
            c, lc, t, lt, d, _ = brute_density(x, share, linked)
            chars, links, tags, link_tags, sums = chars + c, links + lc, tags + t + 1, link_tags + lt + (x[0] == "a"), sums + d
    if not chars:
        return 0, 0, tags, link_tags, 0.0, 0.0
    c, t, lc, lt = chars, max(1, tags), max(1, links), max(1, link_tags)
    base = np.log(np.log(c / max(1, c - links) * links + share * c + np.e) + np.e)
    return chars, links, tags, link_tags, c / t * (np.log(max(1.0, c / lc * t / lt)) + 1e-3) / base, sums


def test_densities_like_recursion():
    rnd = random.Random(6)

    def some(depth, names=("div", "b", "section", "a", "i")):
        inside = ["".join(rnd.choice("ab ") for _ in range(rnd.randrange(12))) for _ in range(rnd.randrange(2))]
        for _ in range(rnd.randrange(4) if depth else 0):
            inside.append(some(depth - 1))
            inside.append("text " * rnd.randrange(3))
        return rnd.choice(names), inside

    def written(node):
        return f"<{node[0]}>" + "".join(x if isinstance(x, str) else written(x) for x in node[1]) + f"</{node[0]}>"

    for _ in range(60):
        inner = [some(3, ("div", "section")) for _ in range(3)]
        tree = extract.Tree("".join(map(written, inner)))
        seen = tree.measure(tree.skip)
        chars, links = [sum(brute_density(n, 0.0)[k] for n in inner) for k in (0, 1)]
        share, order = links / max(1, chars), []

        def visit(node, inside_link):
            order.append((node, inside_link))
            for x in node[1]:
                if not isinstance(x, str):
                    visit(x, inside_link or node[0] == "a")

        for n in inner:
            visit(n, False)
        assert [tree.tag[k + 1] for k in range(len(order))] == [n[0] for n, _ in order]
        for k, (node, inside_link) in enumerate(order, 1):
            if not inside_link:
                want = brute_density(node, share)
                assert np.isclose(seen.density[k], want[4]) and np.isclose(seen.sums[k], want[5])


def test_time_grows_with_the_length_of_a_page():
    import time

    pages = ["<span>" * 100_000 + "x", "<center>" * 100_000 + "x", "<ul><li>" * 50_000 + "x", "<p><td>" + "<ul>" * 50_000 + "x", """<a "b' >""" * 20_000, """<a b="c' >""" * 20_000, "<a b=' " * 20_000, "<!--" * 30_000]
    for page in pages:
        start = time.process_time()
        assert extract.main_text(page) in ("x", "")
        assert time.process_time() - start < 6, page[:20]


def test_quotes_count_in_values_only():
    assert extract.main_text("<p title='a > b'>one</p><p x\">two</p><p y=\"never closed>three</p>") == "one\ntwo\nthree"


def test_main_text_of_odd_pages(spark):
    assert [extract.main_text(p) for p in ("", "   ", "<", "<nav>x</nav>", "a < b")] == ["", "", "<", "", "a < b"]
    assert extract.main_text("<div>" * 5000 + "deep text here") == "deep text here"
    pages = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "<p>x</p>", 1)], "page_id long, url string, html string, main_text int")
    assert sorted(r.main_text for r in extract.extracted(pages).select("main_text").collect()) == ["", "", "x"]


def test_preference_pairs(spark):
    turns = [
        (1, 0, "user", "hi", 1), (1, 1, "assistant", "a", 1), (2, 0, "user", "hi", 1), (2, 1, "assistant", "bb", 1), (2, 1, "assistant", "bb", 1),
        (3, 0, "user", "hi", 1), (3, 1, "assistant", None, 1), (5, 0, None, "alone", 1), (None, 0, "user", "x", 1),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, opening int")
    got = {r.chosen_id: r for r in chat.formatted(chat.preference_pairs(table)).collect()}
    assert set(got) == {1, 3, 5}
    one = got[1]
    assert (one.rejected_id, one.n_common, one.prompt) == (2, 1, "<|user|>\nhi<|end|>\n")
    assert (one.chosen_completion, one.chosen_mask) == ("<|assistant|>\na<|end|>\n", "0:14,1:9")
    assert one.rejected_mask == "0:14,1:10" and got[3].rejected_id is None and got[3].chosen_mask == "0:14,1:8"
    assert (got[5].prompt, got[5].chosen_completion, got[5].rejected_completion) == ("<||>\nalone<|end|>\n", "", None)
    assert chat.formatted(chat.preference_pairs(table.where("false"))).count() == 0


def test_preference_pairs_of_distant_conversations(spark):
    ids = {"hi": [*range(3, 3000, 7), 5000, 10**6, -(10**15), 10**15], "ho": [1023, 1024, 2048], "he": [70_000]}
    turns = [(i, 0, "user", o) for o, all_ in ids.items() for i in all_] + [(i, 1, "assistant", f"a{i}") for all_ in ids.values() for i in all_]
    got = chat.preference_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    want = {(s[k], s[k + 1] if k + 1 < len(s) else None) for s in map(sorted, ids.values()) for k in range(0, len(s), 2)}
    assert len(got) == len(want) and {(r.chosen_id, r.rejected_id) for r in got} == want
    assert all(r.chosen[1].text == f"a{r.chosen_id}" and (r.rejected is None or r.rejected[1].text == f"a{r.rejected_id}") for r in got)


def test_preference_query_like_its_sql(spark, tmp_path):
    import duckdb

    from slotwise.llm import queries

    rnd, turns = random.Random(9), []
    openings = [f"question {k}" for k in range(60)] + [None, ""]
    for conv in rnd.sample(range(10**6), 700):
        said = [("user", rnd.choice(openings))] + [("assistant", rnd.choice(["yes", "no", None])) if t % 2 else ("user", rnd.choice(["why", ""])) for t in range(1, rnd.randrange(1, 7))]
        said = [("system", "be kind"), *said] if rnd.random() < 0.2 else said
        for t, (role, text) in enumerate(said):
            turns += [(conv, t if rnd.random() < 0.98 else None, role if rnd.random() < 0.97 else None, text)] * rnd.choice([1, 1, 1, 2])
    turns += [(2 * 10**6 + c, t, "ua"[t % 2], f"same {t}") for c in range(9) for t in range(4)]  # an odd group of equal conversations
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(path)
    rows = queries.op2_preference_format(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    result = con.execute(queries.OP2_SQL)
    names = [d[0] for d in result.description]
    want = [dict(zip(names, r)) for r in result.fetchall()]
    assert sum(r["rejected_id"] is not None for r in want) > 250 and max(r["n_common"] for r in want if r["rejected_id"]) > 3
    key = lambda r: r["chosen_id"]
    assert sorted((r.asDict() for r in rows), key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    items = spark.createDataFrame([], "item_id long, text string")
    assert substrings.drop_repeats(none).count() == near.near_groups(none).count() == 0
    assert decontaminate.contamination(none, items).count() == bpe.round_trip(none).count() == 0
    assert decontaminate.decontaminate(frame(spark, [(1, "x")]), items).count() == 1
    assert language.fit(none, F.lit(True)) is None
    assert quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True)) is None
