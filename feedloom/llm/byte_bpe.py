"""Byte-level BPE: texts to token ids with offsets, and ids back to bytes and text.

The merges of the tokenizers library are derived from a rank file: a token of several
bytes is merged from the two parts that its own bytes end up in under all lower ranks.
Texts come as Arrow batches. Each is cut by the pattern, and each different piece of the
batches so far goes through the library once, which gives its ids and, as the library
shows bytes as characters, offsets in the characters of the piece; a batch is then put
together with numpy. Decoding has a table of bytes by id and lays them end to end.

Offsets are in code points of the text, end exclusive. A character may be split over
several tokens; these all cover it whole, and ``n_split`` counts tokens that begin or end
inside one. ``decode`` gives the bytes, which are exact; ``decode_text`` also gives the text,
with U+FFFD for the broken bytes of a run of tokens that begins or ends inside a character.

Defined cases: a null text is an empty one and has no tokens; whole texts are encoded,
whatever their length; equal texts have equal ids; special tokens are ordinary text; ids
that the table doesn't have are an error; further columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import array
import base64
import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, text_of

#: Pieces that a worker remembers; then it forgets them all. Results don't depend on it.
CACHED_PIECES = 600_000


@functools.lru_cache(1)
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What a token's bytes are merged to by the ranks below its own."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 1:
        options = [
            (ranks.get(a + b, limit), i)
            for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
        ]
        rank, i = min(options)
        if rank >= limit:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def _byte_characters() -> list[str]:
    """The character by which byte-level BPE shows each byte: printable ones show
    themselves, the others follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


@functools.lru_cache(1)
def library_encoder(path: str):
    """A tokenizer of the tokenizers library for one piece, made from a rank file."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    table, show = byte_table(path), _byte_characters()
    name = lambda token: "".join(map(show.__getitem__, token))
    ranks = {token: rank for rank, token in enumerate(table) if token}
    merges = [
        tuple(map(name, parts))
        for token in table
        if len(token) > 1 and len(parts := _parts(token, ranks)) == 2
    ]
    vocabulary = {name(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


@functools.lru_cache(1)
def cutter(pattern: str):
    """A function that cuts a text into the matches of the pattern.

    Texts of Latin-1 characters are cut by the standard library, which is faster but
    has no Unicode classes: the pattern's classes are spelled out for these 256
    characters. All other texts are cut by the pattern itself.
    """
    import regex

    whole = regex.compile(pattern).findall
    latin = [chr(i) for i in range(256)]
    spelled = {
        name: "".join(re.escape(c) for c in latin if regex.fullmatch(name, c))
        for name in (r"\p{L}", r"\p{N}", r"\s")
    }
    named = re.compile(r"\\p\{[LN]\}|\\s")
    members = lambda m: spelled[m[0]]
    short = re.sub(  # a bracket keeps its own brackets
        r"(\[\^?)((?:\\p\{[LN]\}|\\s)+)\]",
        lambda m: m[1] + named.sub(members, m[2]) + "]\0",
        pattern,
    )
    short = "".join(
        part if part.startswith("[") else named.sub(lambda m: f"[{spelled[m[0]]}]", part)
        for part in re.split(r"(\[[^\0]*\]\0)", short)
    ).replace("]\0", "]").replace(r"\S", "[^" + spelled[r"\s"] + "]")
    latin_cut = re.compile(short).findall

    def cut(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return whole(text)
        return latin_cut(text)

    return cut


class _Codes(dict):
    """A number for each piece, given out when it is first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        self.new.append(piece)
        return code


class PieceEncoder:
    """Pieces to runs in flat arrays of ids, starts and ends, each piece encoded once."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.cut, self.tokenizer = cutter(pattern), library_encoder(path)
        self.clear()

    def clear(self) -> None:
        self.code = _Codes()
        self.first = np.zeros(1, np.int64)
        self.ids = self.starts = self.ends = np.empty(0, np.int32)
        self.chars = self.split = np.empty(0, np.int32)

    def learn(self) -> None:
        """Encode the pieces that have just got a number, many in one call."""
        new, self.code.new = self.code.new, []
        if not new:
            return
        counts, ids, offsets = [], [], []
        for i in range(0, len(new), 4096):
            found = self.tokenizer.encode(
                new[i : i + 4096], is_pretokenized=True, add_special_tokens=False
            )
            counts.append(np.bincount(found.word_ids, minlength=len(new[i : i + 4096])))
            ids.append(np.array(found.ids, np.int32))
            offsets.append(np.array(found.offsets, np.int32).reshape(-1, 2))
        counts, ids, offsets = map(np.concatenate, (counts, ids, offsets))
        starts, ends = offsets[:, 0], offsets[:, 1]
        owner = np.repeat(np.arange(len(new)), counts)
        # Neighbours in one piece that overlap share a character.
        shared = (starts[1:] < ends[:-1]) & (owner[1:] == owner[:-1])
        inside = np.zeros(len(starts), bool)
        inside[1:] |= shared
        inside[:-1] |= shared
        add = lambda old, more: np.append(old, np.asarray(more, old.dtype))
        self.split = add(self.split, np.bincount(owner[inside], minlength=len(new)))
        self.first = add(self.first, self.first[-1] + np.cumsum(counts))
        self.ids, self.starts, self.ends = add(self.ids, ids), add(self.starts, starts), add(self.ends, ends)
        self.chars = add(self.chars, [len(piece) for piece in new])

    def encode(self, texts: list[str]):
        """Tokens per text, then ids, starts and ends of all texts, and split tokens per text."""
        if len(self.code) > CACHED_PIECES:
            self.clear()
        lengths, codes = [], array.array("i")
        for text in texts:
            pieces = self.cut(text)
            lengths.append(len(pieces))
            codes.extend(map(self.code.__getitem__, pieces))
        self.learn()
        codes = np.frombuffer(codes, np.int32) if codes else np.empty(0, np.int32)
        bounds = np.append(0, np.cumsum(lengths, dtype=np.int64))

        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values, dtype=np.int64))
            return total[bounds[1:]] - total[bounds[:-1]]

        begin = self.first[codes]
        counts = self.first[codes + 1] - begin
        after = np.cumsum(counts)
        index = np.arange(after[-1] if len(after) else 0) - np.repeat(after - counts - begin, counts)
        # Where a piece starts, in all texts and in its own.
        at = np.append(0, np.cumsum(self.chars[codes], dtype=np.int64))
        at = at[:-1] - np.repeat(at[bounds[:-1]], lengths)
        shift = np.repeat(at, counts).astype(np.int32)
        return (
            per_text(counts), self.ids[index], self.starts[index] + shift,
            self.ends[index] + shift, per_text(self.split[codes]),
        )


ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>, n_split long"


def _encoded(encoder: PieceEncoder, batch: pa.RecordBatch, offsets: bool) -> pa.RecordBatch:
    counts, ids, starts, ends, split = encoder.encode(batch["text"].to_pylist())
    bounds = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (ids, starts, ends)]
    if not offsets:
        lists[1:] = [pa.nulls(batch.num_rows, pa.list_(pa.int32()))] * 2
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], *lists, pa.array(split, pa.int64())],
        ["doc_id", "ids", "starts", "ends", "n_split"],
    )


def _decoded(table: list[bytes], batch: pa.RecordBatch, kept: list[str]) -> pa.RecordBatch:
    texts = [b"".join(map(table.__getitem__, ids or ())) for ids in _lists(batch["ids"])]
    return pa.RecordBatch.from_arrays(
        [batch[name] for name in kept] + [pa.array(texts, pa.binary())], [*kept, "decoded"]
    )


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = True) -> DataFrame:
    """doc_id, ids, starts, ends (both null without ``offsets``), n_split of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path, pattern)
        for batch in sliced(batches):
            yield _encoded(encoder, batch, offsets)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encoded`` but the offsets, and the bytes its ids stand for."""
    kept = [name for name in encoded.columns if name not in ("starts", "ends")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for batch in sliced(batches):
            yield _decoded(table, batch, kept)

    schema = encoded.select(*kept).schema
    return encoded.select(*kept).mapInArrow(run, schema.add("decoded", "binary"))


def encode_and_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As ``decode`` of what ``encode`` returns, in one worker: of two in a row, a task has
    both at once, and an executor keeps them and their tables for the next tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = PieceEncoder(path, pattern), byte_table(path)
        for batch in sliced(batches):
            yield _decoded(table, _encoded(encoder, batch, False), ["doc_id", "ids", "n_split"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_split long, decoded binary")


def decode_text(encoded: DataFrame, path: str) -> DataFrame:
    """As ``decode``, and the text of the bytes, U+FFFD in the place of broken ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [None if b is None else b.decode("utf-8", "replace") for b in batch["decoded"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    decoded = decode(encoded, path)
    schema = decoded.select("*").schema  # ``add`` changes the schema it is called on
    return decoded.mapInArrow(run, schema.add("text", "string"))


def _lists(ids: pa.ListArray) -> Iterator[list[int]]:
    for row in ids:
        values = row.values
        yield values.to_numpy().tolist() if values is not None else []
