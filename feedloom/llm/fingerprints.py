"""Document fingerprints by winnowing.

Every run of GRAM code points is hashed (polynomial, computed for all places at once by
doubling); of each WINDOW neighbouring hashes the smallest is kept, the rightmost of
equal ones. So of any passage of WINDOW + GRAM - 1 code points that two texts share, they
share a fingerprint, and each kept hash has its position. The likeness of two documents
is the Jaccard coefficient of their kept hashes.

``edited`` compares each text with its edited form, made of its own first half and the
beginning of the next document's text. Next means by descending doc_id, so documents are
dealt into ranges of doc_id, and the first of each range is also sent to the range before
it; tasks then stream through sorted rows with two texts in hand.

Defined cases: a null text is an empty one, with an empty fingerprint; two empty
fingerprints have likeness 1, an empty and another one 0; texts shorter than GRAM are one
gram, fewer grams than WINDOW one window; a null doc_id comes last; rows with equal
doc_ids follow each other by their text; a single row is its own next; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, text_of

GRAM = 8
WINDOW = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
_SCRAMBLE = np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all runs of ``gram`` code points; of the whole if it is shorter."""
    if not len(points):
        return np.empty(0, np.uint64)
    gram = min(gram, len(points))
    # The hash of a long run is that of its beginning, times a power of BASE, plus that of
    # the rest. Runs of 1, 2, 4, ... points are made by doubling and joined to ``gram``.
    double, size, power = points.astype(np.uint64) + np.uint64(1), 1, BASE
    whole, covered = None, 0
    with np.errstate(over="ignore"):
        while True:
            if gram & size:
                if whole is None:
                    whole = double
                else:
                    count = len(points) - covered - size + 1
                    whole = whole[:count] * power + double[covered : covered + count]
                covered += size
            if covered == gram:
                break
            double = double[: len(double) - size] * power + double[size:]
            power = power * power
            size *= 2
        whole = (whole ^ (whole >> np.uint64(31))) * _SCRAMBLE
    return whole >> np.uint64(32)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, by position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    hashes = gram_hashes(points, gram)
    if not len(hashes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    # Equal hashes are told apart by place, the rightmost being the smallest.
    places = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - places)
    width, size = min(window, len(hashes)), 1
    while 2 * size <= width:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < width:
        rest = width - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
    kept = least[np.append(True, least[1:] != least[:-1])]
    at = (np.uint64(0xFFFFFFFF) - (kept & np.uint64(0xFFFFFFFF))).astype(np.int64)
    # A place can win again only without a break, so places are already in order.
    return (kept >> np.uint64(32)).astype(np.uint32), at


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard coefficient of two sets of hashes, each sorted and without repeats."""
    if not len(one) and not len(other):
        return 1.0
    both = np.concatenate([one, other])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, hashes, positions of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [winnow(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([h.astype(np.int64) for h, _ in made], pa.list_(pa.int64())),
                    pa.array([at for _, at in made], pa.list_(pa.int64())),
                ],
                ["doc_id", "hashes", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def steps_of(positions: np.ndarray, window: int = WINDOW) -> str:
    """Positions as steps from one to the next, the first from the beginning, in hexadecimal
    digits of equal width; a step is never longer than the window."""
    steps, width = np.diff(positions, prepend=0), len(f"{window:x}")
    digits = steps[:, None] >> (4 * np.arange(width)[::-1]) & 15
    return np.frombuffer(b"0123456789abcdef", np.uint8)[digits].tobytes().decode()


def places_of(steps: str, window: int = WINDOW) -> np.ndarray:
    """The positions that ``steps_of`` has written."""
    width = len(f"{window:x}")
    return np.cumsum([int(steps[i : i + width], 16) for i in range(0, len(steps), width)], dtype=np.int64)


class _Doc:
    """A text in hand, with what is computed of it once."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.hashes, self.places = winnow(text)
        self.set = np.unique(self.hashes)


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("steps", pa.string()), ("edited_steps", pa.string()),
])


def _compare(doc: _Doc, following: _Doc) -> tuple:
    half = len(doc.text) // 2
    edited = doc.text[: len(doc.text) - half] + following.text[:half]
    changed, at = winnow(edited)
    as_text = lambda hashes: hashes.astype(">u4").tobytes().hex()
    return (
        doc.doc_id, len(doc.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_text(doc.hashes), as_text(changed),
        likeness(doc.set, np.unique(changed)), likeness(doc.set, following.set),
        steps_of(doc.places), steps_of(at),
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range and order; the last row of a range is the head of the next one."""
    before, part, out = None, None, []
    for batch in sliced(batches, 128):
        columns = [batch[name].to_pylist() for name in ("range", "head", "doc_id", "text")]
        for number, head, doc_id, text in zip(*columns, strict=True):
            doc = _Doc(doc_id, text)
            if before is not None and number == part:
                out.append(_compare(before, doc))
            before, part = (None if head else doc), number
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(zip(*out, strict=True), _RESULT, strict=True)],
                schema=_RESULT,
            )
            out = []


def edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each text's fingerprint beside those of its edited form and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hashes by position, 8
    hexadecimal digits each), near_edited, near_next, steps, edited_steps (the positions of the
    hashes, as ``steps_of`` writes them). ``ranges``: how many ranges of
    doc_id to deal rows into; the session's shuffle width if not given. What comes to the
    driver is one number for each range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    ids = rows.select("doc_id").where("doc_id is not null")
    bounds = sorted(set(ids.approxQuantile("doc_id", shares, 1 / (8 * ranges)))) if shares else []
    limits = np.array(bounds)

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        # Descending: range 0 has the largest; nulls come last.
        place = len(limits) - np.searchsorted(limits, doc_id.fillna(-np.inf).to_numpy(float), "left")
        return pd.Series(np.where(doc_id.isna(), len(limits) + 1, place).astype(np.int32))

    dealt = rows.withColumn("range", range_of("doc_id"))
    firsts = dealt.select("range", "doc_id").groupBy("range").agg(
        F.max("doc_id").alias("first"), F.count(F.lit(1)).alias("n")
    ).orderBy("range").collect()
    # Whose head each range gets: that of the range after it, and the last that of the first.
    before = {row["range"]: firsts[i - 1]["range"] for i, row in enumerate(firsts)}
    heads = spark.createDataFrame(
        [(row["range"], row["first"], before[row["range"]]) for row in firsts],
        "at int, first long, to int",
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    # A head is the first by text of the rows with its doc_id.
    copies = (
        dealt.join(F.broadcast(heads), (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("to", "doc_id").agg(F.min("text").alias("text"))
        .select(F.col("to").alias("range"), F.lit(True).alias("head"), "doc_id", "text")
    )
    everything = dealt.select("range", F.lit(False).alias("head"), "doc_id", "text").unionByName(copies)
    return (
        everything.repartition(ranges, "range")
        .sortWithinPartitions("range", "head", *order)
        .mapInArrow(_stream, _spark_schema())
    )


def _spark_schema() -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in _RESULT)
