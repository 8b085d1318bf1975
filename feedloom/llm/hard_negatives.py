"""Hard negatives of anchors, with exact integer scores by the method of Four Russians.

Components become whole numbers. A candidate is stored as bit planes: for each bit of
two's complement and each group of eight dimensions one byte. An anchor has, for each
group, the sums of all 256 subsets of its eight components. A score is then a lookup by
each byte of the candidate, shifted by the place of its bit and added up, the sign bit
with a minus: the full inner product, nothing rounded.

Anchors (ids divisible by ``every``) meet all rows in cells of some thousand rows by some
hundred anchors, each cell one group of a cogroup; the best of a cell go on to a ranking
per anchor. One pass finds an anchor's positives, the best rows of its label. The second
finds, for each positive, the best rows of other labels within a band of its score.

Defined cases: rows with a null label, a null vector, or a null or non-finite component
take no part; shorter vectors are as if filled up with zeros; every row counts, also one
that repeats another, and two anchors with one id both have their results; a null id is
no anchor and comes after all others among equal scores; an anchor without another row of
its label, or a positive without rows in its band, gives no rows; further columns are
ignored; an empty table gives no rows. Scores beyond 64 bits stop the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored

GROUP = 8
#: Rows and anchors of one cell, about.
CELL_ROWS = 8192
CELL_ANCHORS = 512
#: Anchors whose tables and scores are in hand at once.
AT_ONCE = 32

POSITIVES, NEGATIVES = 5, 10
#: A negative has between these hundredths of the positive's score.
BAND = (30, 90)


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id, label, q: rows that take part, their components times ``scale`` rounded down."""
    component = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    too_large = F.raise_error(F.lit("a component is beyond 62 bits")).cast("long")
    whole = F.transform(component, lambda x: F.when(
        F.abs(x * F.lit(float(scale))) < F.lit(2.0**62), F.floor(x * F.lit(float(scale)))
    ).otherwise(too_large))
    return rows.where(F.col("label").isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("q")
    )


def bit_planes(q: np.ndarray, planes: int) -> np.ndarray:
    """Rows by planes by groups: bit p of eight neighbouring components in one byte."""
    rows, dims = q.shape
    padded = np.zeros((rows, -(-dims // GROUP) * GROUP), np.int64)
    padded[:, :dims] = q
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(q: np.ndarray) -> np.ndarray:
    """Anchors by groups by 256: the sum of each subset of a group's components."""
    anchors, dims = q.shape
    padded = np.zeros((anchors, -(-dims // GROUP) * GROUP), q.dtype)
    padded[:, :dims] = q
    groups = padded.reshape(anchors, -1, GROUP)
    sums = np.zeros((*groups.shape[:2], 1), q.dtype)
    for i in range(GROUP):  # a subset with component i: one without it, and the component
        sums = np.concatenate([sums, sums + groups[:, :, i : i + 1]], axis=2)
    return sums


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Anchors by rows: inner products, from subset sums and bit planes."""
    depth, groups = planes.shape[1:]
    total = None
    for p in range(depth):
        part = tables[:, 0, :].take(planes[:, p, 0], axis=1)
        for g in range(1, groups):
            part += tables[:, g, :].take(planes[:, p, g], axis=1)
        part = part << p if part.dtype != object else part * (1 << p)
        if p == depth - 1:  # the sign of two's complement
            total = -part if total is None else total - part
        else:
            total = part if total is None else total + part
    return total


def _number_type(anchors: np.ndarray, planes: int) -> type:
    """The smallest numbers in which no score or part of one can overflow."""
    bound = int(np.abs(anchors.astype(object)).sum(axis=1).max(initial=0)) << planes
    return np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object


def _matrix(lists: pa.ChunkedArray, dims: int) -> np.ndarray:
    column = lists.combine_chunks()
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    at = np.arange(len(row)) - np.repeat(starts, lengths)
    out[row, at] = column.flatten().to_numpy()
    return out


def _cell(anchors: pa.Table, rows: pa.Table, dims: int, planes: int, choose) -> pa.Table:
    """All anchors of a cell against all its rows; ``choose`` picks from a row of scores.

    Rows come by label and by id, null ids last, so equal scores are in order already.
    """
    label = rows["label"].to_numpy()
    ids = rows["id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((ids.fill_null(0).to_numpy(), null))
    ids, label = ids.take(pa.array(order)), label[order]
    groups = -(-dims // GROUP)
    packed = np.frombuffer(b"".join(rows["planes"].to_pylist()), np.uint8).reshape(-1, planes, groups)[order]
    q = _matrix(anchors["q"], dims)
    kind = _number_type(q, planes)
    by_label = np.argsort(anchors["label"].to_numpy(), kind="stable")
    at, taken, value, chosen = [], [], [], []
    for few in (by_label[i : i + AT_ONCE] for i in range(0, len(q), AT_ONCE)):
        tables = subset_sums(q[few].astype(kind))
        for one, found in choose(anchors.take(pa.array(few)), tables, packed, label):
            at.append(np.full(len(found["row"]), few[one]))
            taken.append(found["row"])
            value.append(found["score"])
            chosen.append(found["rank"])
    empty = np.empty(0, np.int64)
    at, taken, chosen = (np.concatenate([empty, *part]).astype(np.int64) for part in (at, taken, chosen))
    value = np.concatenate([empty.astype(object), *value])
    named = anchors.select(["anchor", "anchor_id"]).take(pa.array(at))
    return pa.table({
        "anchor": named["anchor"], "anchor_id": named["anchor_id"],
        "positive": pa.array(chosen), "row_id": ids.take(pa.array(taken)),
        "score": pa.array([int(v) for v in value], pa.int64()),
    })


_BEST = "anchor long, anchor_id long, positive long, row_id long, score long"


def _positives(dims: int, planes: int, keep: int):
    """The best rows of each anchor's own label, itself among them."""

    def choose(anchors, tables, packed, label):
        wanted = anchors["label"].to_numpy()
        for own in np.unique(wanted):
            mine, rows = np.flatnonzero(wanted == own), np.flatnonzero(label == own)
            if not len(rows):
                continue
            for one, row in zip(mine, scores(tables[mine], packed[rows]), strict=True):
                best = np.argsort(-row, kind="stable")[:keep]
                yield one, {"row": rows[best], "score": row[best], "rank": np.zeros(len(best), np.int64)}

    return lambda anchors, rows: _cell(anchors, rows, dims, planes, choose)


def _negatives(dims: int, planes: int, keep: int, band: tuple[int, int]):
    """For each positive of each anchor, the best rows of other labels in its band."""

    def choose(anchors, tables, packed, label):
        positives = anchors["positives"].to_pylist()
        for one, (own, row) in enumerate(zip(anchors["label"].to_numpy(), scores(tables, packed), strict=True)):
            # Whole numbers n with low * score <= 100 * n <= high * score.
            bands = [(-(-band[0] * s // 100), band[1] * s // 100) for s in positives[one]]
            least, most = min(b[0] for b in bands), max(b[1] for b in bands)
            rows = np.flatnonzero((label != own) & (row >= least) & (row <= most))
            rows = rows[np.argsort(-row[rows], kind="stable")]
            falling = -row[rows]
            for rank, (low, high) in enumerate(bands):
                start = int(np.searchsorted(falling, -high, "left"))
                stop = int(np.searchsorted(falling, -low, "right"))
                best = rows[start : min(stop, start + keep)]
                yield one, {"row": best, "score": row[best], "rank": np.full(len(best), rank)}

    return lambda anchors, rows: _cell(anchors, rows, dims, planes, choose)


def _best(cells: DataFrame, keep: int, by: list[str]) -> DataFrame:
    """The first ``keep`` of each anchor; every task ranks its own before rows move."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("row_id").asc_nulls_last())
    return cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND, cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: id, label, q of ``whole_vectors``.
    """
    rows = stored(vectors.withColumn("place", F.monotonically_increasing_id()), "vectors")
    is_anchor = F.col("id") % every == 0
    # x and -1 - x need the same bits of two's complement.
    most = F.max(F.array_max(F.transform("q", lambda x: F.when(x < 0, -1 - x).otherwise(x))))
    seen = rows.agg(
        F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.coalesce(most, F.lit(0)).alias("most"),
        F.coalesce(F.max(F.size("q")), F.lit(0)).alias("dims"),
    ).first()
    dims, planes = max(seen["dims"], 1), int(seen["most"]).bit_length() + 1
    down, across = -(-seen["n"] // cell_rows) or 1, -(-seen["anchors"] // cell_anchors) or 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                made = bit_planes(_matrix(pa.chunked_array([part["q"]]), dims), planes)
                yield pa.RecordBatch.from_arrays(
                    [part["place"], part["id"], part["label"],
                     pa.array([m.tobytes() for m in made], pa.binary())],
                    ["place", "id", "label", "planes"],
                )

    packed = stored(rows.mapInArrow(pack, "place long, id long, label long, planes binary"), "bit-planes")
    anchors = rows.where(is_anchor).select(
        F.col("place").alias("anchor"), F.col("id").alias("anchor_id"), "label", "q"
    )

    def every_one(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cells(of: DataFrame, choose) -> DataFrame:
        """Each anchor group with each row group, in a task's hands together."""
        left = of.withColumn("i", F.pmod(F.xxhash64("anchor"), F.lit(across)).cast("int")).withColumn(
            "j", every_one(down)
        )
        right = packed.withColumn("j", F.pmod(F.xxhash64("place"), F.lit(down)).cast("int")).withColumn(
            "i", every_one(across)
        )
        return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(choose, _BEST)

    # The anchor's own row is the best of its label unless it is short; leave it out once.
    own = anchors.select(
        "anchor", F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("self")
    )
    near = _best(cells(anchors, _positives(dims, planes, positives + 1)), positives + 1, ["anchor"])
    same = F.col("row_id").eqNullSafe(F.col("anchor_id")) & (F.col("score") == F.col("self"))
    listed = near.join(own, "anchor").groupBy("anchor").agg(
        F.min(F.when(same, F.col("rank"))).alias("at"),
        F.array_sort(F.collect_list(F.struct("rank", "row_id", "score"))).alias("found"),
    )
    kept = F.slice(
        F.filter("found", lambda f: ~f["rank"].eqNullSafe(F.col("at"))), 1, positives
    )
    chosen = stored(listed.select("anchor", kept.alias("chosen")).where("size(chosen) > 0"), "positives")
    asking = anchors.join(
        chosen.select("anchor", F.transform("chosen", lambda f: f["score"]).alias("positives")), "anchor"
    )
    hard = _best(cells(asking, _negatives(dims, planes, negatives, band)), negatives, ["anchor", "positive"])
    positive = F.get("chosen", F.col("positive").cast("int"))
    return hard.join(chosen, "anchor").select(
        "anchor_id", positive["row_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("row_id").alias("negative_id"), positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
