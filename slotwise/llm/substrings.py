"""Substring dedup by relative Lempel-Ziv parsing against the whole corpus.

Reference blocks. The starts of all windows of `WINDOW` words are cut into blocks of neighbouring
windows that share the same least hash of `ANCHOR` words. The cut follows from the words alone, so
equal windows lie in blocks with equal anchors wherever they occur. The index of blocks is dealt
out by anchor; an entry holds the places of its windows and a fingerprint for each.

Parsing. Every window is looked up in the index: the reply is the first place in the corpus with
the same words, if that is earlier. In each document, replies are joined from left to right into
factors for as long as the reference goes on too. A factor has a window's length at least, and as
every window is looked up, also those over a boundary between two factors are.

Equal blocks of one task are sent once, the others are known to repeat it; so a passage that a
third of all documents hold costs the index one entry for each task. Texts are shuffled once, to
meet the replies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import NO_ID, arrays, batches, binary, id_key, packed_rows, rest_of
from slotwise.llm.words import VISIBLE, WORD_BASE, Words, _ranges, buffer_of, joined_all, mixed, sliced

WINDOW, ANCHOR = 20, 6
#: Windows gathered in a task before its blocks are sent, and text per part of the index.
FLUSH_WINDOWS, BUCKET_BYTES = 1 << 20, 16 << 20

_ASK = [np.uint64, np.int64, np.uint32, np.uint32, np.uint8, np.uint8, np.uint32]
_REPLY = [np.uint32, np.uint32, np.uint32, np.int64, np.uint32]
_TAG = np.uint64(0xFFFFFFFF)


def _blocks(words: Words, keys: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, hash of the block, key, tag, start, number of windows, places to the anchor,
    fingerprints of all windows) of the blocks of a slice."""
    at, hashes = words.runs(window)
    near, grams = words.runs(ANCHOR)
    span = window - ANCHOR + 1
    every = np.full(len(words.starts) + span, np.iinfo(np.uint64).max, np.uint64)
    every[near] = grams
    anchor_at = np.lib.stride_tricks.sliding_window_view(every, span)[at].argmin(1) + at
    first = np.flatnonzero(np.diff(anchor_at, prepend=-1))
    sizes = np.diff(np.append(first, len(at)))
    text = np.searchsorted(words.first, at[first], "right") - 1
    tags = (words.whole() & _TAG).astype(np.uint32)
    whole = _ranges(hashes, first, first + sizes, WORD_BASE)
    return (
        every[anchor_at[first]], whole, keys[text], tags[text], (at[first] - words.first[text]).astype(np.uint32),
        sizes.astype(np.uint8), (anchor_at[first] - at[first]).astype(np.uint8), hashes.astype(np.uint32),
    )


def _flat(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, number within the block) of every window."""
    sizes = sizes.astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _by_document(key, tag, start, count, ref, ref_start) -> Iterator[tuple[int, bytes]]:
    order = np.lexsort((start, key))
    key = key[order]
    cuts = np.flatnonzero(np.diff(key)) + 1
    parts = [c[order] for c in (tag, start, count, ref, ref_start)]
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(key)), strict=True):
        if b > a:
            yield int(key[a]), binary([p[a:b].astype(t, copy=False) for p, t in zip(parts, _REPLY, strict=True)])


def _send(parts: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per part of the index, and one per document with blocks that repeat others here."""
    anchor, whole, key, tag, start, sizes, ahead = (np.concatenate([p[i] for p in parts]) for i in range(7))
    prints = np.concatenate([p[7] for p in parts])
    # Blocks with a clash of hashes would differ in size or anchor; those are part of the order.
    order = np.lexsort((start, key, sizes, ahead, anchor, whole))
    same = np.zeros(len(order), bool)
    if len(order):
        a, b = order[1:], order[:-1]
        same[1:] = (whole[a] == whole[b]) & (anchor[a] == anchor[b]) & (sizes[a] == sizes[b]) & (ahead[a] == ahead[b])
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    known = same & ((key[order] != key[lead]) | (start[order] != start[lead]))
    out: list[tuple[int, int | None, bytes]] = []
    k, r = order[known], lead[known]
    for doc, body in _by_document(key[k], tag[k], start[k], sizes[k], key[r], start[r]):
        out.append((int(mixed(np.array([doc], np.int64).view(np.uint64))[0] % np.uint64(buckets)), doc, body))
    sent = np.sort(order[~known])
    bucket = (anchor[sent] % np.uint64(buckets)).astype(np.int64)
    turn = np.argsort(bucket, kind="stable")
    sent, bucket = sent[turn], bucket[turn]
    begin = np.cumsum(sizes.astype(np.int64)) - sizes
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for n in range(buckets):
        s = sent[cuts[n] : cuts[n + 1]]
        if len(s):
            owner, step = _flat(sizes[s])
            out.append((n, None, binary([anchor[s], key[s], tag[s], start[s], sizes[s], ahead[s], prints[begin[s][owner] + step]])))
    for i in range(0, len(out), 500):
        yield packed_rows(["bucket", "key", "body"], [list(c) for c in zip(*out[i : i + 500], strict=True)], [pa.int32(), pa.int64(), pa.binary()])


def _entries(window: int, buckets: int) -> Callable:
    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in rows:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, words in sliced(batch.column(1), VISIBLE):
                if (words.counts >= window).any():
                    parts.append(_blocks(words, keys[a:b], window))
                    held += len(parts[-1][7])
                if held >= FLUSH_WINDOWS:
                    yield from _send(parts, buckets)
                    parts, held = [], 0
        if parts:
            yield from _send(parts, buckets)

    return cut


def _resolve(table: pa.Table) -> pa.Table:
    """The replies of one part of the index, a row per document."""
    keys, bodies = table.column("key").to_pylist(), table.column("body").to_pylist()
    out = [(k, b) for k, b in zip(keys, bodies, strict=True) if k is not None]
    asked = [arrays(b, _ASK) for k, b in zip(keys, bodies, strict=True) if k is None]
    del bodies
    if asked:
        anchor, key, tag, start, sizes, ahead, prints = (np.concatenate(c) for c in zip(*asked, strict=True))
        del asked
        order = np.lexsort((start, key))
        begin = (np.cumsum(sizes.astype(np.int64)) - sizes)[order]
        anchor, key, tag, start, sizes, ahead = (c[order] for c in (anchor, key, tag, start, sizes, ahead))
        owner, step = _flat(sizes)
        # A window is known by its anchor, the anchor's place in it and its fingerprint.
        same = prints[begin[owner] + step].astype(np.uint64) | ((ahead[owner].astype(np.uint64) - step.astype(np.uint64)) << np.uint64(32))
        same = mixed(anchor[owner] + mixed(same))
        turn = np.argsort(same, kind="stable")
        fresh = np.append(True, np.diff(same[turn]) != 0)
        lead = turn[np.maximum.accumulate(np.where(fresh, np.arange(len(turn)), 0))]
        first = np.empty(len(turn), np.int64)
        first[turn] = lead
        at = start[owner].astype(np.int64) + step
        ref, ref_at = key[owner[first]], at[first]
        repeat = (ref != key[owner]) | (ref_at != at)
        w = np.flatnonzero(repeat)
        if len(w):
            go_on = (np.diff(owner[w]) == 0) & (np.diff(at[w]) == 1) & (np.diff(ref[w]) == 0) & (np.diff(ref_at[w]) == 1)
            opens = np.append(0, np.flatnonzero(~go_on) + 1)
            count = np.diff(np.append(opens, len(w)))
            o = w[opens]
            out += _by_document(key[owner[o]], tag[owner[o]], at[o], count, ref[o], ref_at[o])
    return pa.table({"key": pa.array([k for k, _ in out], pa.int64()), "body": pa.array([b for _, b in out], pa.binary())})


def replies(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, body): for each document, where windows repeat an earlier place."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, -(-size // BUCKET_BYTES))
    entries = docs.select(id_key().alias("key"), "text").mapInArrow(_entries(window, buckets), "bucket int, key long, body binary")
    return entries.groupBy("bucket").applyInArrow(_resolve, "key long, body binary")


def greedy_factors(bodies: list[bytes], tag: int) -> np.ndarray:
    """Rows (start, windows, reference, its start) of one document, from left to right, each as
    long as the reference goes on."""
    parts = [np.column_stack([c.astype(np.int64) for c in r[1:]])[r[0] == tag] for r in (arrays(b, _REPLY) for b in bodies)]
    rows = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 0]))]
    size = rows[:-1, 1]
    go_on = (rows[1:, 0] == rows[:-1, 0] + size) & (rows[1:, 2] == rows[:-1, 2]) & (rows[1:, 3] == rows[:-1, 3] + size)
    opens = np.append(0, np.flatnonzero(~go_on) + 1)
    out = rows[opens]
    out[:, 1] = np.add.reduceat(rows[:, 1], opens)
    return out


def _with_replies(docs: DataFrame, window: int) -> DataFrame:
    batches(docs.sparkSession)
    told = replies(docs, window).groupBy(F.col("key").alias("told_key")).agg(F.collect_list("body").alias("told"))
    rows = docs.select(rest_of(docs, "text").alias("rest"), "text", id_key().alias("key"))
    return rows.join(told, F.col("key") == F.col("told_key"), "left").select("rest", "text", "told")


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, words, ref_doc_id, ref_start): maximal factors, in words."""
    schema = "doc_id long, start long, words long, ref_doc_id long, ref_start long"

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, told = batch.column(0).to_pylist(), batch.column(2)
            for a, _, words in sliced(batch.column(1), VISIBLE):
                tags = words.whole() & _TAG
                for t in range(len(words)):
                    found = greedy_factors(told[a + t].as_py() or [], int(tags[t]))
                    n = len(found)
                    ref = [None if r == NO_ID else r for r in found[:, 2].tolist()]
                    yield packed_rows(
                        ["doc_id", "start", "words", "ref_doc_id", "ref_start"],
                        [[ids[a + t]] * n, found[:, 0], found[:, 1] + window - 1, ref, found[:, 3]],
                        [pa.int64()] * 5,
                    )

    rows = _with_replies(docs, window)
    return rows.select(F.col("rest.doc_id").cast("long").alias("doc_id"), "text", "told").mapInArrow(parse, schema)


def _cut(texts: pa.Array, words: Words, keep: np.ndarray) -> pa.Array:
    """The texts without the words that go and the white space behind each; null stays null. All
    other bytes stay as they are."""
    gone = np.flatnonzero(~keep)
    until = words.ends.copy()
    inner = np.flatnonzero(np.diff(words.owner) == 0)
    until[inner] = words.starts[inner + 1]
    edges = np.zeros(len(words.data) + 1, np.int8)
    edges[words.starts[gone]] += 1
    edges[until[gone]] -= 1
    live = np.cumsum(edges[:-1], dtype=np.int8) == 0
    data, kept_before = words.data[live], np.concatenate(([0], np.cumsum(live)))
    to = kept_before[buffer_of(texts)[1]]
    return pa.array(
        [bytes(data[x:y]) if valid else None for x, y, valid in zip(to[:-1], to[1:], texts.is_valid().to_pylist(), strict=True)], pa.binary()
    ).cast(pa.string())


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of `docs`, `text` being the kept words joined by single blanks, in one struct
    column `row`, with n_words, n_removed and kept_sha256.

    A word goes if a window of `window` words over it stands earlier too (smaller doc_id, or
    earlier in the same document), as the input was. Null, empty and shorter texts lose nothing
    (null becomes empty). A null doc_id sorts first. Rows that repeat a doc_id are the same
    document: their equal places are not earlier than each other.
    """
    return _without_repeats(docs, window, in_place=False)


def _without_repeats(docs: DataFrame, window: int, in_place: bool) -> DataFrame:
    """`in_place`: passages are cut out of the texts, which otherwise stay as they are."""
    rows = _with_replies(docs, window)
    rest = rows.schema["rest"].dataType
    schema = f"rest {rest.simpleString()}, kept string, n_words long, n_removed long, kept_sha256 string"

    def parse(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            rest_column, told = batch.column(0), batch.column(2)
            for a, b, words in sliced(batch.column(1), VISIBLE):
                edges = np.zeros(len(words.starts) + 1, np.int64)
                tags = words.whole() & _TAG
                for t in np.flatnonzero(np.asarray(told.slice(a, b - a).is_valid())):
                    found = greedy_factors(told[a + int(t)].as_py(), int(tags[t]))
                    np.add.at(edges, words.first[t] + found[:, 0], 1)
                    np.add.at(edges, words.first[t] + found[:, 0] + found[:, 1] + window - 1, -1)
                keep = np.cumsum(edges[:-1]) == 0
                data, to = joined_all(words, keep)
                texts = [bytes(data[x : max(x, y - 1)]) for x, y in zip(to[:-1], to[1:], strict=True)]
                gone = np.concatenate(([0], np.cumsum(~keep)))[words.first]
                yield pa.RecordBatch.from_arrays(
                    [
                        rest_column.slice(a, b - a),
                        _cut(batch.column(1).slice(a, b - a), words, keep) if in_place else pa.array(texts, pa.binary()).cast(pa.string()),
                        pa.array(words.counts, pa.int64()),
                        pa.array(np.diff(gone), pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                    ],
                    ["rest", "kept", "n_words", "n_removed", "kept_sha256"],
                )

    done = rows.mapInArrow(parse, schema)
    of = {"text": F.col("kept")}
    if in_place and "n_chars" in docs.columns:
        of["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("rest.n_chars"))
    columns = [of[c].alias(c) if c in of else F.col(f"rest.`{c}`") for c in docs.columns]
    return done.select(F.struct(*columns).alias("row"), "n_words", "n_removed", "kept_sha256")


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` with repeated passages cut out of `text`, and `n_chars` set anew where
    that was done. All else of a text stays as it is, white space included."""
    return _without_repeats(docs, window, in_place=True).select("row.*")
