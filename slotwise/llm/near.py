"""Near-duplicate documents by SetSketch registers.

A register holds the exponent, to base `BASE`, of the least of a document's shingle hashes under
one of many hash functions, cut to a byte: exponentially spaced truncated minima. Registers of a
union are the greater ones of its parts, so sketches can be merged; equal registers tell of a
shared least shingle, so bands of registers serve as keys of buckets. Within a bucket the counts
of greater, smaller and equal registers give the likeliest similarity of a pair, with the exact
sizes of both sets. Pairs whose likeliest value is within five standard deviations of the
threshold are verified on the full sets of shingles.

Documents with equal sets are one class from the start. A bucket does not send out all its pairs:
a first round verifies a spanning forest of its likeliest pairs, a second one the pairs between
members that the links found so far leave apart, if they can still be similar. For that it takes
odd sketches of the sets: a bit tells whether an odd number of shingles has its hash, so bits in
which two sketches differ are at most as many as shingles in which the sets differ. This bound is
exact and excludes no link. A pair is looked at in the first bucket alone that both share. A
bucket of more than 512 classes is cut into parts, and each two parts are worked on by themselves;
nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows, stored
from slotwise.llm.graph import components
from slotwise.llm.words import VISIBLE_LOWER, WORD_BASE, Words, _ranges, mixed, sliced

#: 32 bands of 5 registers: a pair at a similarity of 0.85 shares none with a chance of 3e-9.
REGISTERS, BAND = 160, 5
BASE, RATE, TOP = 1.1, 20.0, 255
PART, GATHER, BRIDGES = 256, 4096, 96
ODD_BITS = 2048
_SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, ordered; a shorter text is one shingle as a whole."""
    at, hashes = words.runs(size)
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    text = np.concatenate((np.searchsorted(words.first, at, "right") - 1, few))
    hashes = np.concatenate((hashes, _ranges(words.hashes, words.first[few], words.first[few + 1], WORD_BASE)))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[fresh], hashes[fresh]


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of registers per set; the sets lie behind each other from `starts` on."""
    least = np.empty((len(starts), REGISTERS), np.uint64)
    for k, seed in enumerate(_SEEDS):
        least[:, k] = np.minimum.reduceat(hashes * seed, starts)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    level = np.floor(1 - np.log(np.maximum(exponential, 1e-300) / RATE) / np.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint8)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, k1, k2, regs): size, 128-bit name and registers of each set; no name if empty."""
    names = ["doc_id", "n", "k1", "k2", "regs"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def sketch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, words in sliced(batch.column(1), VISIBLE_LOWER):
                text, hashes = shingles(words, size)
                n = np.bincount(text, minlength=b - a)
                regs, k1, k2 = [None] * (b - a), [None] * (b - a), [None] * (b - a)
                full = np.flatnonzero(n)
                if len(full):
                    starts = np.searchsorted(text, full)
                    one = np.add.reduceat(mixed(hashes), starts).view(np.int64).tolist()
                    two = np.add.reduceat(mixed(hashes ^ np.uint64(WORD_BASE)), starts).view(np.int64).tolist()
                    for t, x, y, r in zip(full.tolist(), one, two, registers(hashes, starts), strict=True):
                        k1[t], k2[t], regs[t] = x, y, r.tobytes()
                yield packed_rows(names, [batch.column(0)[a:b], n, k1, k2, regs], types)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketch, "doc_id long, n long, k1 long, k2 long, regs binary"
    )


def likeliest(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, total: int = REGISTERS) -> np.ndarray:
    """The similarity of greatest likelihood, given how many registers of a are greater and smaller."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    c, log = (BASE - 1) / BASE, np.log(BASE)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    same = total - more - less
    for _ in range(24):
        j = (low + high) / 2
        x, y = 1 - (u - v * j) * c, 1 - (v - u * j) * c
        p, q = np.maximum(-np.log(x) / log, 1e-12), np.maximum(-np.log(y) / log, 1e-12)
        dp, dq = v * c / (x * log), u * c / (y * log)
        rising = same * (dp + dq) / np.maximum(1 - p - q, 1e-12) > more * dp / p + less * dq / q
        low, high = np.where(rising, j, low), np.where(rising, high, j)
    return high


def forest(count: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which pairs form a spanning forest of greatest weight: each part takes its best pair, again and again."""
    order = np.argsort(-weight, kind="stable")
    a, b = a[order], b[order]
    label, chosen = np.arange(count), np.zeros(len(a), bool)
    live = np.arange(len(a))
    while len(live):
        x, y = label[a[live]], label[b[live]]
        apart = x != y
        live, x, y = live[apart], x[apart], y[apart]
        if not len(live):
            break
        _, best = np.unique(np.column_stack((x, y)).ravel(), return_index=True)
        take = np.unique(best // 2)
        chosen[live[take]] = True
        s, t = x[take], y[take]
        while True:  # the least label of joined parts
            low = label.copy()
            np.minimum.at(low, s, label[t])
            np.minimum.at(low, t, label[s])
            low = low[low]
            if (low == label).all():
                break
            label = low
            s, t = label[s], label[t]
        label = label[label]
    out = np.zeros(len(order), bool)
    out[order[chosen]] = True
    return out


def _pairs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within the consecutive groups, at most some 60,000 at a time or one row's."""
    first = np.cumsum(sizes) - sizes
    after = np.repeat(first + sizes, sizes) - np.arange(sizes.sum()) - 1
    total = np.concatenate(([0], np.cumsum(after)))
    row = 0
    while row < len(after):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + 60_000, "right")) - 1)
        a = np.repeat(np.arange(row, stop), after[row:stop])
        yield a, a + 1 + np.arange(len(a)) - np.repeat(total[row:stop] - total[row], after[row:stop])
        row = stop


def _candidates(percent: int, apart: bool) -> Callable:
    """Pairs of a partition's buckets to verify: forests, or all pairs of different components.
    With forests, a pair (x, x) tells that x has candidates, but none of them is sent out here."""
    t = percent / 100
    least = t - 5 * (t * (1 - t) / REGISTERS) ** 0.5

    def look(cols: list[pa.ChunkedArray], group: np.ndarray) -> pa.RecordBatch:
        rep, n, band, part, root = (cols[i].to_numpy() for i in range(5))
        regs = np.frombuffer(b"".join(cols[5].to_pylist()), np.uint8).reshape(-1, REGISTERS)
        whole = cols[6].to_numpy() == cols[7].to_numpy()
        odd = np.frombuffer(b"".join(cols[8].to_pylist()), np.uint64).reshape(-1, ODD_BITS // 64) if apart else None
        found: list[tuple[np.ndarray, ...]] = []
        for a, b in _pairs(np.diff(np.append(np.flatnonzero(group), len(group)))):
            ok = (rep[a] != rep[b]) & (whole[a] | (part[a] != part[b])) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
            if apart:
                ok &= root[a] != root[b]
            a, b = a[ok], b[ok]
            x, y = regs[a], regs[b]
            same = (x == y).reshape(len(a), REGISTERS // BAND, BAND).all(2)
            ok = same.argmax(1) == band[a]
            a, b, x, y = a[ok], b[ok], x[ok], y[ok]
            if apart:
                unlike = np.bitwise_count(odd[a] ^ odd[b]).sum(1, dtype=np.int64)
                ok = (100 + percent) * unlike <= (100 - percent) * (n[a] + n[b])
                a, b, x, y = a[ok], b[ok], x[ok], y[ok]
            if len(a):
                value = likeliest((x > y).sum(1), (x < y).sum(1), n[a], n[b])
                ok = value >= least
                found.append((a[ok], b[ok], value[ok]))
        a, b, value = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        if not apart and len(a):
            keep = forest(len(rep), a, b, value)
            a, b, value = a[keep], b[keep], value[keep]
            # Two parts of one bucket are bridged by some pairs; the second round tests the rest. For
            # that, a class that is left in no pair goes on as a pair with itself.
            own = np.cumsum(group)[a]
            order = np.lexsort((-value, own))
            place = np.empty(len(a), np.int64)
            place[order] = np.arange(len(a)) - np.searchsorted(own[order], own[order])
            keep = whole[a] | (place < BRIDGES)
            left = np.setdiff1d(rep[np.concatenate((a[~keep], b[~keep]))], rep[np.concatenate((a[keep], b[keep]))])
            low = np.concatenate((np.minimum(rep[a], rep[b])[keep], left))
            high = np.concatenate((np.maximum(rep[a], rep[b])[keep], left))
        else:
            low, high = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
        return packed_rows(["a", "b"], [low, high], [pa.int64(), pa.int64()])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            marks = [table.column(c).to_numpy() for c in ("key", "i", "j")]
            opens = np.append(True, np.any([m[1:] != m[:-1] for m in marks], axis=0)) if len(table) else np.zeros(0, bool)
            end = len(table) if last else int(np.flatnonzero(opens)[-1])
            if end:
                yield look([table.column(c)[:end].combine_chunks() for c in ("rep", "n", "band", "part", "root", "regs", "i", "j", "odd")], opens[:end])
            held[:] = table[end:].to_batches()

        for batch in rows:
            held.append(batch)
            if sum(map(len, held)) >= GATHER:
                yield from flush(False)
        if held:
            yield from flush(True)

    return run


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep, band, c): classes that share a band of registers with others, c being how many."""
    keys = [F.xxhash64(F.lit(k), F.substring("regs", BAND * k + 1, BAND)) for k in range(REGISTERS // BAND)]
    bands = classes.select("rep", F.posexplode(F.array(*keys)).alias("band", "key"))
    shared = stored(bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    return bands.join(shared, "key")


def _grouped(members: DataFrame, classes: DataFrame, roots: DataFrame | None = None, odd: DataFrame | None = None) -> DataFrame:
    full = members.join(classes, "rep")
    if roots is None:
        full = full.withColumn("root", F.col("rep")).withColumn("odd", F.lit(None).cast("binary"))
    else:
        full = full.join(roots.toDF("r", "root"), F.col("rep") == F.col("r"), "left").withColumn("root", F.coalesce("root", "rep"))
        full = full.join(odd, "rep")
    parts = F.when(F.col("c") > 2 * PART, F.ceil(F.col("c") / PART)).otherwise(1).cast("int")
    full = full.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
    full = full.withColumn("q", F.explode(F.sequence(F.lit(0), parts - 1)))
    full = full.withColumn("i", F.least("part", "q")).withColumn("j", F.greatest("part", "q"))
    return full.select("key", "i", "j", "rep", "n", "band", "part", "root", "odd", "regs").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            a, b, left, right = batch.columns
            ok = []
            for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                place = np.searchsorted(y, x)
                shared = int((y[np.minimum(place, len(y) - 1)] == x).sum())
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            ok = np.array(ok, bool)
            yield packed_rows(["u", "v"], [a.to_numpy()[ok], b.to_numpy()[ok]], [pa.int64(), pa.int64()])

    one, two = sets.toDF("a", "left"), sets.toDF("b", "right")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(compare, "u long, v long")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    def collect(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b, words in sliced(batch.column(1), VISIBLE_LOWER):
                text, hashes = shingles(words, size)
                cut = np.searchsorted(text, np.arange(b - a + 1))
                bodies = [hashes[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield packed_rows(["rep", "set"], [batch.column(0)[a:b], bodies], [pa.int64(), pa.binary()])

    # Sorted and merged at every size, so that small inputs show what large ones cost.
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted.hint("merge"), "rep", "left_semi")
    return rows.mapInArrow(collect, "rep long, set binary").where(F.length("set") > 0)


def _odd_sketches(sets: DataFrame) -> DataFrame:
    """(rep, odd): the odd sketch of each set."""

    def sketch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            bodies = []
            for body in batch.column(1).to_pylist():
                place = mixed(np.frombuffer(body, np.uint64)) % np.uint64(ODD_BITS)
                bodies.append(np.packbits(np.bincount(place.astype(np.int64), minlength=ODD_BITS) & 1).tobytes())
            yield packed_rows(["rep", "odd"], [batch.column(0), bodies], [pa.int64(), pa.binary()])

    return sets.mapInArrow(sketch, "rep long, odd binary").distinct()


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the least doc_id reachable by
    links of at least `percent` percent similarity) and kept (whether that is its own).

    Sets hold the distinct shingles of `size` words, a shorter text as one shingle. Null and empty
    texts have no shingles and no links. Rows that repeat a doc_id are one document. A row without
    doc_id is counted, but cannot name a group: component_id is null and it is kept.
    """
    batches(docs.sparkSession)
    drawn = stored(sketches(docs, size), "sketches")
    named = drawn.where("n > 0 AND doc_id IS NOT NULL")
    least = named.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "regs")).alias("m"))
    classes = stored(least.select("k1", "k2", "n", F.col("m.doc_id").alias("rep"), F.col("m.regs").alias("regs")), "classes")
    own = classes.select("rep", "n", "regs")
    members = stored(buckets(own), "members")
    likely = stored(_grouped(members, own).mapInArrow(_candidates(percent, False), "a long, b long").distinct(), "likely")
    able = likely.selectExpr("explode(array(a, b)) rep").distinct()  # every class with a candidate
    sets = stored(_sets(docs, able, size), "sets")
    links = stored(_verified(likely.where("a <> b"), sets, percent), "verified")
    roots = components(links)
    open_ = members.join(able, "rep", "left_semi")
    odd = stored(_odd_sketches(sets), "odd")
    rest = stored(_grouped(open_, own, roots, odd).mapInArrow(_candidates(percent, True), "a long, b long").distinct(), "rest")
    more = stored(_verified(rest.join(likely, ["a", "b"], "left_anti"), sets, percent), "verified")
    roots = components(more.union(roots))
    rep = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("n").alias("cn"), "rep")
    found = drawn.join(rep, F.expr("k1 = c1 AND k2 = c2 AND n = cn AND doc_id IS NOT NULL"), "left")
    found = found.join(roots.toDF("r", "root"), F.col("rep") == F.col("r"), "left")
    component = F.coalesce("root", "rep", "doc_id")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of `docs`, with all its columns: that of the least doc_id. Rows that
    repeat a doc_id are one document, of which the row of the greatest hash stays. A row without
    doc_id goes by a hash of its text, beyond 2**62, so that documents with an id go before it."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    text = F.coalesce(F.col("r.text"), F.lit(""))
    own = F.coalesce(F.col("r.doc_id").cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))
    rows = rows.withColumn("own", own)
    groups = near_groups(rows.select(F.col("own").alias("doc_id"), F.col("r.text").alias("text")), size, percent)
    found = stored(groups.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")).where("n > 1 OR NOT kept"), "odd")
    found = found.withColumnRenamed("doc_id", "own")
    single = rows.join(found.select("own").hint("merge"), "own", "left_anti")
    repeated = rows.join(found.where("kept").select("own"), "own", "left_semi")
    first = repeated.groupBy("own").agg(F.max_by("r", F.xxhash64("r")).alias("r"))
    return single.select("r").union(first.select("r")).select("r.*")
