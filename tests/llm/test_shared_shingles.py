"""Shingles of several documents, found by blocks, and prefixes made of them."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import jaccard_join
from feedloom.llm.jaccard_join import _blocks, _cut, _maybe, _packed, _shared_of, _unpacked, emitted, prefix_length


def node_sets(draw, number, common):
    """Sets of hashes by node, with some hashes in most of them and an equal set size now and then."""
    some = lambda k: [draw.randrange(-(2**63), 2**63) for _ in range(k)]
    hot, warm = some(common), some(60)
    sets = {}
    for i in range(number):
        values = np.unique(np.array(some(draw.randrange(1, 40)) + hot[draw.randrange(common) :] + draw.sample(warm, 9), np.int64))
        count = len(emitted(values, 0))
        sets[draw.randrange(-(2**63), 2**63), len(values) << 32 | count] = values
    return sets


def brute_prefixes(sent, order):
    """sent: lists of batches of (node, emitted shingles); each batch counts a node once."""
    frequency, owners = Counter(), defaultdict(set)
    for batch in sent:
        for node, values in dict(batch).items():
            for token in values.tolist():
                frequency[token] += 1
                owners[token].add(node)
    found = {}
    for node, values in {k: v for batch in sent for k, v in batch}.items():
        first = jaccard_join.in_class(values, order).tolist()
        ranks = sorted(
            (not f, frequency[t] if f else 0, t)
            for t, f in zip(values.tolist(), first, strict=True) if len(owners[t]) > 1
        )
        places = max(prefix_length(node[1] >> 32) - (len(values) - len(ranks)), 0)
        if ranks[:places]:
            found[node] = (1 - len(ranks) / len(values), [r[2] for r in ranks[:places]])
    return found


def prefixes(sent, order, buckets, rows_at_once):
    """The same by blocks, shuffled as Spark does."""
    kinds = pa.list_(pa.int64())
    blocks = []
    for task in sent:  # each is a task of its own
        batch = pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k, _ in task], pa.int64()) for i in (0, 1)] + [pa.array([v for _, v in task], kinds)],
            ["cls", "size", "emitted"],
        )
        for made in _blocks(buckets, order)(iter([batch])):
            blocks += made.to_pylist()
    blocks.sort(key=lambda r: (r["bucket"], r["late"]))
    kinds = pa.schema([("bucket", pa.int32()), ("late", pa.bool_()), ("data", pa.binary())])
    rows = []
    cuts = range(0, len(blocks), rows_at_once)
    for made in _shared_of(pa.RecordBatch.from_pylist(blocks[i : i + rows_at_once], kinds) for i in cuts):
        rows += made.to_pylist()
    rows.sort(key=lambda r: (r["cls"], r["size"]))
    parts = (pa.RecordBatch.from_pylist(rows[i : i + rows_at_once]) for i in range(0, len(rows), rows_at_once))
    return [r for made in _cut(order)(parts) for r in made.to_pylist()]


@pytest.mark.parametrize("order", [0, 1])
@pytest.mark.parametrize(("buckets", "rows_at_once", "most"), [(1, 7, 3), (50, 1, 100_000), (5000, 1000, 5)])
def test_prefixes_by_blocks(monkeypatch, order, buckets, rows_at_once, most):
    monkeypatch.setattr(jaccard_join, "MOST_IN_ROW", most)
    draw = random.Random(order + buckets)
    sets = list(node_sets(draw, 60, 12).items())
    sent = [[(k, emitted(v, order)) for k, v in sets[i::4]] for i in range(4)]
    if not order:  # a set that several tasks have
        sent[1].append(sent[0][0])
        sent[2] += [sent[0][0], sent[0][0]]
    made = prefixes(sent, order, buckets, rows_at_once)
    found = {(r["node"]["cls"], r["node"]["size"]): (r["lone"], r["prefix"]) for r in made}
    assert len(found) == len(made)
    assert found == brute_prefixes(sent, order)


def test_what_only_equal_sets_share_is_not_shared():
    values = np.arange(40, dtype=np.int64) * 7919
    node = (5, len(values) << 32 | len(emitted(values, 0)))
    assert prefixes([[(node, emitted(values, 0))]] * 3, 0, 4, 100) == []


@pytest.mark.parametrize("length", [0, 1, 2, 1000])
def test_blocks_are_read_as_written(length):
    columns = np.random.default_rng(1).integers(-(2**63), 2**63, (4, length))
    back = _unpacked(_packed(columns))
    assert (back == columns).all()
    back[0] = 0  # its reader sums in place


@pytest.mark.parametrize("buckets", [8, 3000])
def test_a_lone_shingle_takes_few_bytes_in_a_shuffle(buckets):
    """24 bytes a shingle with a row each, at 0.5 GB, and more with more partitions."""
    draw = np.random.default_rng(2)
    nodes = [(int(draw.integers(2**62)), 500 << 32 | 188) for _ in range(5000)]
    sent = [draw.integers(-(2**63), 2**63, 188) for _ in nodes]
    batch = pa.RecordBatch.from_arrays(
        [*(pa.array([k[i] for k in nodes]) for i in (0, 1)), pa.array(sent, pa.list_(pa.int64()))], ["cls", "size", "emitted"]
    )
    size = sum(
        pa.compress(r["data"], "lz4_raw").size + 12
        for made in _blocks(buckets, 0)(iter([batch])) for r in made.to_pylist()
    )
    assert size < 18 * sum(map(len, sent))


def test_few_texts_that_are_not_wanted_are_shuffled(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    wanted = rows.where("id % 50 = 0").select("key")
    passed = {r["id"] for r in _maybe(rows, wanted).collect()}
    assert passed >= set(range(0, 20_000, 50)) and len(passed) < 400 + 2_000
    assert _maybe(rows, wanted.limit(0)).count() == 0
