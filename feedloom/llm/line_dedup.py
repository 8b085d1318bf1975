"""Line dedup: repeated lines found by hash in one sorted stream, kept lines as bitmaps.

Every document sends each different key of its lines once: a 128-bit hash of the key,
the document and the places of the lines. These rows are dealt into ranges of (hash,
document, first place) and sorted by them, so a task streams through runs of equal
hashes and holds no more than ``min_docs`` rows of one. Ranges may cut a run, however
long, anywhere: a run at the end of a range reports its count, and runs that are too
short in one range are judged by the sum over all. What comes back per document is not
text but a bitmap of kept lines, compressed as lengths of its runs.

A line's key is the line without ASCII white space at both ends, with A-Z in lower case.
Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose their
lines: all of them, or all but the first occurrence by (doc_id, text digest, place) with
``keep_first``.

Defined cases: a null text is an empty one and has one empty line; a null doc_id comes
before any other; every row is a document of its own, but rows with equal doc_id and text
get the same bitmap; a document without dropped lines has no bitmap; further columns are
ignored; an empty table gives no rows. Documents are told apart by doc_id and a 64-bit
digest of their text, keys by their 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, stored, text_of

BLANKS = b" \t\n\x0b\x0c\r"

_KEYS = "h long, g long, doc_id long, digest long, first int, places array<int>"
_ORDER = ("h", "g", "doc_id", "digest", "first")


def _documents(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")
    )


def _ints(values, kind=np.int32) -> pa.Array:
    return pa.array(np.asarray(values, kind))


def _lists(values: list[list[int]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return pa.ListArray.from_arrays(_ints(offsets), _ints([x for v in values for x in v]))


def line_keys(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row for each document and different key of its lines, with their places."""

    def long_enough(key: bytes) -> bool:
        return min_chars <= 0 or len(key) >= min_chars and (
            min_chars == 1 or len(key.decode("utf-8", "replace")) >= min_chars
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            owner, hashes, places = [], [], []
            for i, text in enumerate(batch["text"].cast(pa.binary()).to_pylist()):
                held: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.lower().split(b"\n")):
                    held.setdefault(line.strip(BLANKS), []).append(place)
                for key, found in held.items():
                    if long_enough(key):
                        owner.append(i)
                        hashes.append(xxhash.xxh3_128_digest(key))
                        places.append(found)
            pair = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            document = batch.select(["doc_id", "digest"]).take(_ints(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    _ints(pair[:, 0], np.int64), _ints(pair[:, 1], np.int64), *document.columns,
                    _ints([found[0] for found in places]), _lists(places),
                ],
                ["h", "g", "doc_id", "digest", "first", "places"],
            )

    return _documents(docs).mapInArrow(run, _KEYS)


#: A found row is to be dropped (h is null), waits for the whole of its run (places are
#: set), or tells how many documents a task has of a run at the end of its range.
_FOUND = "h long, g long, part int, lead boolean, doc_id long, digest long, places array<int>, docs long"


def _changes(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    """For every row but the first: does it differ from the row before in these columns?"""
    differ = np.zeros(max(batch.num_rows - 1, 0), bool)
    for name in names:
        column = batch[name]
        values, null = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
        differ |= (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    return differ


class _Stream:
    """The sorted rows of one range, run by run."""

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.part = TaskContext.get().partitionId() if TaskContext.get() else 0
        self.opening = True  # the run in hand is the first of the range
        self.rows: pa.RecordBatch | None = None  # of the run in hand, as long as it is short
        self.last: pa.RecordBatch | None = None  # the last row of the run in hand
        self.lead: pa.RecordBatch | None = None  # the first row of the run in hand
        self.docs = 0

    def found(self, rows: pa.RecordBatch, waiting: bool = False, lead: bool = False, docs=None) -> pa.RecordBatch:
        n = rows.num_rows
        longs = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                rows["h"] if waiting else longs, rows["g"] if waiting else longs,
                _ints([self.part] * n), pa.array([lead] * n), rows["doc_id"], rows["digest"],
                rows["places"] if docs is None else pa.nulls(n, pa.list_(pa.int32())),
                longs if docs is None else _ints([docs] * n, np.int64),
            ],
            ["h", "g", "part", "lead", "doc_id", "digest", "places", "docs"],
        )

    def dropped(self, rows: pa.RecordBatch, leads: np.ndarray) -> pa.RecordBatch:
        """Rows of runs known to be long; rows that repeat the document before are left out."""
        fresh = np.append(True, _changes(rows, _ORDER[:4]))
        places = rows["places"]
        if self.keep_first:
            parts = [p[1:] if lead else p for p, lead in zip(places.to_pylist(), leads, strict=True)]
            places = _lists(parts)
        rows = rows.set_column(rows.schema.get_field_index("places"), "places", places)
        return self.found(rows.filter(pa.array(fresh)))

    def extend(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """More rows of the run in hand."""
        before, self.docs = self.docs, self.docs + rows.num_rows
        if before == 0:
            self.lead = rows.slice(0, 1)
        if self.docs < self.min_docs:
            self.rows = rows if before == 0 else _joined([self.rows, rows])
        elif before < self.min_docs:  # long from now on
            held = rows if before == 0 else _joined([self.rows, rows])
            self.rows = None
            if self.keep_first and self.opening:  # its first row may lie in an earlier range
                yield self.found(self.lead, waiting=True, lead=True)
                # Twins of the first row say what it says.
                twins = np.append(True, np.cumsum(_changes(held, _ORDER[:4])) == 0)
                held = held.filter(pa.array(~twins))
                if held.num_rows:
                    yield self.dropped(held, np.zeros(held.num_rows, bool))
            else:
                yield self.dropped(held, np.arange(held.num_rows) == 0)
        else:
            both = _joined([self.last, rows])
            new = self.dropped(both, np.zeros(both.num_rows, bool)).slice(1)
            if new.num_rows:
                yield new
        self.last = rows.slice(rows.num_rows - 1)

    def close(self, at_end: bool) -> Iterator[pa.RecordBatch]:
        """The run in hand has ended here; another range may have more of it."""
        if self.docs and (self.opening or at_end):
            yield self.found(self.lead, waiting=True, docs=self.docs)
            if self.rows is not None:
                yield self.found(self.rows.slice(0, 1), waiting=True, lead=True)
                more = self.rows.slice(1).filter(pa.array(_changes(self.rows, _ORDER[:4])))
                if more.num_rows:
                    yield self.found(more, waiting=True)
        self.opening = self.opening and not self.docs
        self.docs, self.rows = 0, None

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(batch, ("h", "g"))) + 1
            starts = np.concatenate([[0], starts, [batch.num_rows]])
            if self.docs and _changes(_joined([self.last, batch.slice(0, 1)]), ("h", "g"))[0]:
                yield from self.close(False)
            head = batch.slice(0, starts[1])
            yield from self.extend(head)
            if len(starts) == 2:
                continue
            yield from self.close(False)
            # Runs that lie whole inside the batch: all but its first and its last one.
            lengths = np.diff(starts)[1:-1]
            long = np.repeat(lengths >= self.min_docs, lengths)
            if long.any():
                inner = batch.slice(starts[1], starts[-2] - starts[1])
                leads = np.zeros(inner.num_rows, bool)
                leads[starts[1:-2] - starts[1]] = True
                yield self.dropped(inner.filter(pa.array(long)), leads[long])
            yield from self.extend(batch.slice(starts[-2]))
        yield from self.close(True)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _packed(places: np.ndarray) -> bytes:
    """A bitmap of kept lines as the lengths of its runs, kept first: 7 bits a byte, low
    ones first, the eighth bit set if more follow. The lines after the last run are kept."""
    breaks = np.flatnonzero(np.diff(places) != 1) + 1
    starts, ends = places[np.append(0, breaks)], places[np.append(breaks - 1, len(places) - 1)] + 1
    edges = np.diff(np.stack([starts, ends], 1).ravel(), prepend=0)
    out = bytearray()
    for length in edges.tolist():
        while length >= 128:
            out.append(length & 127 | 128)
            length >>= 7
        out.append(length)
    return bytes(out)


def unpacked(bitmap: bytes | None, n_lines: int) -> list[bool]:
    """Which of the lines stay."""
    keep, length, shift, kept = [], 0, 0, True
    for byte in bitmap or b"":
        length |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            keep += [kept] * length
            length, shift, kept = 0, 0, not kept
    return keep + [True] * (n_lines - len(keep))


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep_first: bool = True
) -> DataFrame:
    """doc_id, digest, bitmap, n_dropped of the documents that lose lines."""
    if min_docs < 1:
        raise ValueError("a line is in one document at least")
    keys = stored(line_keys(docs, min_chars), "line-keys")
    found = stored(
        keys.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(
            lambda batches: _Stream(min_docs, keep_first).run(batches), _FOUND
        ),
        "line-runs",
    )
    # Two runs at most for each range of the sort.
    totals = found.where("docs is not null").groupBy("h", "g").agg(
        F.sum("docs").alias("all_docs"), F.min(F.struct("doc_id", "digest")).alias("leader")
    ).where(F.col("all_docs") >= min_docs)
    first = F.struct("doc_id", "digest").eqNullSafe(F.col("leader"))
    places = F.when(F.lit(keep_first) & F.col("lead") & first, F.slice("places", 2, F.size("places")))
    settled = (
        found.where("h is not null and docs is null")
        .join(F.broadcast(totals), ["h", "g"])
        .select("doc_id", "digest", F.coalesce(places, "places").alias("places"))
    )
    known = found.where("h is null and docs is null").select("doc_id", "digest", "places")
    lost = (
        known.unionByName(settled).groupBy("doc_id", "digest")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
        .where("size(places) > 0")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            maps = [_packed(np.asarray(places)) for places in batch["places"].to_pylist()]
            counts = pc.list_value_length(batch["places"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["digest"], pa.array(maps, pa.binary()), counts],
                ["doc_id", "digest", "bitmap", "n_dropped"],
            )

    return lost.mapInArrow(pack, "doc_id long, digest long, bitmap binary, n_dropped int")


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, text of every document after its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts, kept = [], []
            for text, bitmap in zip(
                batch["text"].cast(pa.binary()).to_pylist(), batch["bitmap"].to_pylist(), strict=True
            ):
                lines = text.split(b"\n")
                counts.append(len(lines))
                if bitmap is None:
                    kept.append(text)
                else:
                    keep = unpacked(bitmap, len(lines))
                    kept.append(b"\n".join(line for line, stays in zip(lines, keep, strict=True) if stays))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], _ints(counts, np.int64), batch["n_dropped"].cast(pa.int64()).fill_null(0),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    rows = _documents(docs).alias("d")
    same = F.expr("d.doc_id <=> b.doc_id and d.digest = b.digest")
    joined = rows.join(bitmaps.alias("b"), same, "left").select("d.doc_id", "d.text", "bitmap", "n_dropped")
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, text string")


def drop_lines(docs: DataFrame, **rule) -> DataFrame:
    """``kept_lines`` after the rule of ``keep_bitmaps``."""
    return kept_lines(docs, keep_bitmaps(docs, **rule))
