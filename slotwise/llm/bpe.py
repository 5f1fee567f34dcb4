"""Byte-level BPE over Arrow batches, with the ranks of a public vocabulary.

A rank file names tokens as bytes; the tokenizers library wants characters and merges. Bytes are
mapped to printable characters, and every way to put a token together from two others is a merge
of that token's rank, so the library merges what the rank file's own library would. Each match of
the pattern is encoded by itself; as words repeat, a worker keeps the codes of some `KEPT_CHARS`
characters of them. Decoding takes the bytes of each token from the reversed table; a
character that is split over tokens comes out whole once all its bytes are there.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, rest_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core already

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
KEPT_CHARS = 5_000_000
ADJACENT = re.compile(r"\s\s").search


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Codec:
    """Encodes and decodes with one rank file; made once per worker."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
        chars = byte_characters()
        spelled = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
        merges = [
            (spelled[t[:i]], spelled[t[i:]])
            for t in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        vocabulary = {spelled[t]: r for t, r in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.recent: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.chars = 0

    def _learn(self, units: set[str]) -> None:
        """Codes of new units: each of their matches is encoded by itself."""
        matches = {u: self.split(u) for u in units}
        known = self.pieces
        pieces = [p for p in {p for m in matches.values() for p in m} if p not in known]
        for piece, code in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            ids = code.ids
            known[piece] = array("i", ids).tobytes(), b",".join([b"%d" % i for i in ids])
        for unit, found in matches.items():
            if len(found) == 1:
                self.recent[unit] = known[found[0]]
            else:
                both = [known[p] for p in found]
                self.recent[unit] = b"".join([c[0] for c in both]), b",".join([c[1] for c in both])
            self.chars += len(unit)

    def codes(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, ids in decimals) of each unit. Two generations of codes are kept; those used again
        move on to the next."""
        if self.chars > KEPT_CHARS // 2:
            self.older, self.recent, self.chars, self.pieces = self.recent, {}, 0, {}
        out = list(map(self.recent.get, units))
        if None in out:
            new = {u for u, c in zip(units, out, strict=True) if c is None}
            for unit in [u for u in new if u in self.older]:
                self.recent[unit] = self.older[unit]
                self.chars += len(unit)
                new.discard(unit)
            if new:
                self._learn(new)
            out = [self.recent[u] if c is None else c for u, c in zip(units, out, strict=True)]
        return out

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        """(ids, the ids in decimals with commas).

        Matches of the pattern hold a blank at their start or among blanks only. So where no white
        space is next to another, a text falls apart before each blank.
        """
        if not text:
            return np.zeros(0, np.int32), b""
        if text[0] == " " or text[-1] == " " or ADJACENT(text):
            units = self.split(text)
        else:
            first, *units = text.split(" ")
            units = [first, *[" " + u for u in units]]
        coded = self.codes(units)
        ids = np.frombuffer(b"".join([c[0] for c in coded]), np.int32)
        return ids, b",".join([c[1] for c in coded])

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last character (plus one) of every token; tokens that share a character
        overlap there."""
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        sizes = np.array([len(self.bytes_of[i]) for i in ids.tolist()], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        return character[starts], character[ends - 1] + 1


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, path: str = RANKS, offsets: bool = False, proof: bool = False) -> DataFrame:
    """All columns of `docs` in a struct `row`, with `ids` and, if asked for, the character
    offsets `starts` and `ends` of every token, and with `proof` the column `decoded_sha256`, the
    digest of the ids' bytes. Null texts are encoded as empty ones."""
    batches(docs.sparkSession)
    rows = docs.select(rest_of(docs).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>"
    schema += ", starts array<int>, ends array<int>" if offsets else ""
    schema += ", decoded_sha256 string" if proof else ""

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ints = codec(path), pa.list_(pa.int32())
        for batch in batches_in:
            for row in range(0, batch.num_rows, 100):
                part = batch.slice(row, 100)
                texts = part.column(1).to_pylist()
                ids = [own.encode(t)[0] for t in texts]
                out, names = [part.column(0), pa.array(ids, ints)], ["row", "ids"]
                if offsets:
                    spans = [own.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                    out += [pa.array([s[k].astype(np.int32) for s in spans], ints) for k in (0, 1)]
                    names += ["starts", "ends"]
                if proof:
                    out.append(pa.array([hashlib.sha256(own.decode(i.tolist())).hexdigest() for i in ids], pa.string()))
                    names.append("decoded_sha256")
                yield pa.RecordBatch.from_arrays(out, names)

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str = RANKS) -> DataFrame:
    """`rows` with `data`, the bytes of `ids`, and `text`, in which bytes that form no whole
    character are replaced. Null ids stay null; an unknown id is an error."""
    schema = rows.select(*rows.columns).schema.simpleString().removeprefix("struct<").removesuffix(">")
    kept = rows.select(F.struct(*rows.columns).alias("row"), "ids")

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches_in:
            data = [None if i is None else own.decode(i) for i in batch.column(1).to_pylist()]
            text = [None if d is None else d.decode("utf-8", "replace") for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary()), pa.array(text, pa.string())], ["row", "data", "text"]
            )

    return kept.mapInArrow(run, f"row struct<{schema}>, data binary, text string")


def decoded_parts(parts: Iterable[Iterable[int]], path: str = RANKS) -> Iterator[str]:
    """Text for consecutive runs of ids; a character split over two runs comes with the second."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        yield decoder.decode(codec(path).decode(part))
    yield decoder.decode(b"", True)


def round_trip(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts, encoded and decoded again in
    one pass. Null texts count as empty: no tokens and the digests of nothing."""
    batches(docs.sparkSession)

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches_in:
            count, coded, back = [], [], []
            for text in batch.column(1):
                ids, spelled = own.encode(text.as_py() or "")
                count.append(len(ids))
                coded.append(hashlib.sha256(spelled).hexdigest())
                back.append(hashlib.sha256(own.decode(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
