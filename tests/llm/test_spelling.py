"""Spelling variants against all pairs of words."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from slotwise.llm import queries, spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(((-counts[x], x) for x in near), default=None)
        form = best[1] if best and -best[0] >= ratio * n else None
        out[w] = [form, w, n, len(near), counts[form] if form else None]
    for w in out:
        while out[out[w][1]][0] is not None:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    return {r.word: tuple(r)[1:] for r in df.collect()}


def vocabulary(seed, letters, count):
    rnd, words = random.Random(seed), {}
    while len(words) < count:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 9)))
        for _ in range(rnd.randrange(5)):
            words[w] = rnd.choice([5, 6, 25, 30, 125, 700, 4000, 4000])
            i, c = rnd.randrange(len(w)), rnd.choice(letters)
            w = rnd.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :] if len(w) > 6 else w])
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzàÀßÿ"])
def test_variants_like_all_pairs(spark, letters):
    counts = vocabulary(len(letters), letters, 250)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(words)) == expected(counts)


def test_chains_of_forms(spark):
    counts = {"aaaaaa" + "b" * k: 5 * 5**k for k in range(12)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    have = got(spelling.variants(words))
    assert have == expected(counts) and {r[1] for r in have.values()} == {"aaaaaa" + "b" * 11}
    with pytest.raises(ValueError):
        spelling.variants(words, ratio=1)


def test_pivots_are_the_rarest_without_overlap():
    rnd = random.Random(4)
    for _ in range(200):
        places = rnd.sample(range(8), rnd.randrange(3, 7))
        grams = [(p, rnd.randrange(99), rnd.randrange(1, 50)) for p in places]
        least = min(a[2] + b[2] for a in grams for b in grams if b[0] - a[0] >= 2)
        chosen = spelling.pivots(grams)
        assert sum(g[2] for g in chosen) == least and chosen[1][0] - chosen[0][0] >= 2


def test_words_of_texts(spark):
    text = "Kitten KITTEN kitten's kittén Kittens; smitten\nétéétéé ÉTÉÉTÉÉ x1kitten_kittens" + " sitten" * 5
    rows = [(i, text, "k", 1) for i in range(60)] + [(3, None, "k", 1), (None, text, "k", 1), (4, "", "k", 1), (500, "kitten " * 20000, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    words = {}
    for i, t, *_ in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            low = low[: h % len(low)] + low[h % len(low) + 1 :] if h % 199 == 0 else low
            words[low] = words.get(low, 0) + 1
    counts = {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}
    assert got(spelling.variants(spelling.vocabulary(queries.misspelt(docs)))) == expected(counts)
    assert spelling.variants(spelling.vocabulary(queries.misspelt(docs.where("false")))).count() == 0
    plain = spelling.vocabulary(spelling.runs(docs.where(F.col("doc_id") == 500)))
    assert [tuple(r) for r in plain.collect()] == [("kitten", 20000)]
