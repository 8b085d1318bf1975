"""Prefix trie, line dedup and hard negatives against brute force, on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import hard_negatives, line_dedup, prefix_trie

CONV = "conv_id long, turn long, role string, text string, node int, depth int, part int, top string"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text, role = text or "", role or ""
            own[conv].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if built[c] == p).encode()).hexdigest())
        for p, m in members.items()
    )


@pytest.mark.parametrize("part_nodes", [1, 4, 40, prefix_trie.PART_NODES])
def test_trie(spark, part_nodes):
    draw = random.Random(3)
    rows = [
        (c, draw.choice([None, t]), draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "é", "", None]))
        for c in range(-11, 60) for t in range(draw.choice([0, 1, 3, 7, 12]))
    ]
    rows += [(7, t, "user", "deep") for t in range(80)] + [(8, t, "user", "deep") for t in range(60)]
    rows += [(100 + i, t, "user", "same") for i in range(40) for t in range(9)]
    rows += [(None, 1, "user", "x"), (90, None, None, None), (90, None, None, None), (91, 0, "user", "z" * 100_000)]
    frame = spark.createDataFrame([(*row, 1, 2, 3, "t") for row in rows], CONV)
    found = prefix_trie.trie(frame, part_nodes)
    assert Counter(map(tuple, found.collect())) == brute_trie(rows)


def test_trie_without_rows(spark):
    none = spark.createDataFrame([], CONV)
    assert prefix_trie.trie(none).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b", 1, 1, 1, "t")], CONV)).count() == 0


def test_centroids_are_few_levels_deep(monkeypatch):
    """On a chain, each centroid halves: sums are right and paths add up to n log n."""
    n = 4000
    sums = prefix_trie.split_to_the_end([-1, *range(n - 1)], [1] * n, [[1] * n, list(range(n))])
    assert sums[0] == list(range(n, 0, -1))
    assert sums[1][0] == n * (n - 1) // 2 and sums[1][-1] == n - 1
    forest = prefix_trie.split_to_the_end([-1, -1, 0, 0, 1, 4], [5, 1, 1, 2, 1, 9], [[1, 2, 3, 4, 5, 6]])
    assert forest == [[8, 13, 3, 4, 11, 6]]


LINES = "doc_id long, text string, h long, g int, digest int, places string, bitmap int, n_dropped int"


def brute_lines(rows, min_docs, min_chars, keep_first):
    blanks = " \t\n\x0b\x0c\r"
    upper = {c: c + 32 for c in range(65, 91)}
    keyed = [[line.strip(blanks).translate(upper) for line in (t or "").split("\n")] for _, t in rows]
    docs = defaultdict(set)
    for i, keys in enumerate(keyed):
        for key in keys:
            if len(key) >= min_chars:
                docs[key].add(i)
    often = {key for key, where in docs.items() if len(where) >= min_docs}
    out = Counter()
    for (doc_id, text), keys in zip(rows, keyed, strict=True):
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, keys, strict=True) if key not in often]
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def line_rows():
    draw = random.Random(5)
    words = ["Alpha", " alpha\t", "beta", "É é", "", "  ", "ALPHA", "gamma\r", "\x1cx", "日本"]
    rows = [(i, "\n".join(draw.choice([*words, f"own {i} {j}"]) for j in range(draw.randint(0, 9)))) for i in range(150)]
    rows += [(None, None), (None, None), (7, None), (8, ""), (9, "\n\n"), (3, "beta\nbeta"), (3, "beta\nbeta")]
    return rows + [(500 + i, "hot line\nrest") for i in range(400)] + [(1000, "long\n" * 50_000)]


@pytest.mark.parametrize("ranges", [1, 7, 40])
@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 2), (1, 0), (300, 1)])
def test_lines(spark, ranges, min_docs, min_chars):
    rows = line_rows()
    frame = spark.createDataFrame([(*row, 1, 2, 3, "p", 4, 5) for row in rows], LINES)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_dedup.drop_lines(frame, min_docs=min_docs, min_chars=min_chars, keep_first=False)
        kept = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert kept == brute_lines(rows, min_docs, min_chars, False)


@pytest.mark.parametrize("ranges", [1, 40])
def test_first_lines_stay(spark, ranges):
    """Of each key in two documents or more, just the first line by document and place."""
    rows = [(i, t) for i, t in dict(line_rows()).items() if i is not None]
    frame = spark.createDataFrame([(*row, 1, 2, 3, "p", 4, 5) for row in rows], LINES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        found = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(frame, min_docs=2).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(i)
    seen = set()
    for i, text in sorted(rows):
        kept = []
        for line in (text or "").split("\n"):
            k = key(line)
            if not k or len(docs[k]) < 2 or k not in seen:
                kept.append(line)
            seen.add(k)
        assert found[i] == "\n".join(kept), i


def test_bitmaps():
    draw = random.Random(1)
    for n in (1, 5, 300, 5000):
        for share in (0.01, 0.5, 1):
            keep = [draw.random() >= share for _ in range(n)]
            lost = np.flatnonzero(~np.array(keep))
            if len(lost):
                assert line_dedup.unpacked(line_dedup._packed(lost), n) == keep
    assert line_dedup.unpacked(None, 3) == [True] * 3


def test_lines_without_rows(spark):
    assert line_dedup.drop_lines(spark.createDataFrame([], LINES), min_docs=2).count() == 0


VECTORS = "id long, label int, embedding array<float>, q int, place int, anchor int, score int, rank string"


def brute_negatives(rows, positives=5, negatives=10):
    used = [
        (i, label, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, label, v in rows
        if label is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]
    out = Counter()
    for at, (i, label, q) in enumerate(used):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(q, other[2], strict=False)), *other[:2]) for n, other in enumerate(used) if n != at]
        order = sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, pid, _ in [s for s in order if s[2] == label][:positives]:
            found = [s for s in order if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score][:negatives]
            out.update((i, pid, rank + 1, nid, score, value) for rank, (value, nid, _) in enumerate(found))
    return out


def vector_rows():
    draw = np.random.default_rng(4)
    rows = [(i, int(draw.integers(0, 4)), [float(x) for x in draw.normal(0, 0.3, 13)]) for i in range(420)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(40)] + [rows[100], rows[100], rows[200]]
    rows += [(None, 2, rows[5][2]), (None, 2, rows[5][2]), (300, None, rows[5][2]), (500, 1, None), (600, 1, [])]
    rows += [(700, 1, [None] * 13), (800, 2, [float("nan")] * 13), (900, 3, [float("inf")] * 13)]
    return rows + [(1100, 0, [0.5, 0.5]), (1200, 9, [0.1] * 13), (-100, 3, [0.2] * 20), (1300, 2, [-3.0] * 13)]


@pytest.mark.parametrize("cells", [dict(), dict(cell_rows=50, cell_anchors=2)])
def test_negatives(spark, cells):
    rows = vector_rows()
    frame = spark.createDataFrame([(*row, 1, 2, 3, 4, "r") for row in rows], VECTORS)
    found = hard_negatives.mine(hard_negatives.whole_vectors(frame), **cells)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, found.select(*columns).collect())) == brute_negatives(rows)


def test_large_components_are_exact(spark):
    for size in (3.0e4, 2.0e6):
        rows = [(i * 50, i % 2, [size + i, -size, 1.0]) for i in range(12)]
        frame = spark.createDataFrame([(*row, 1, 2, 3, 4, "r") for row in rows], VECTORS)
        found = hard_negatives.mine(hard_negatives.whole_vectors(frame), band=(0, 100))
        ids = {r["anchor_id"]: r["positive_score"] for r in found.where("rank = 1").collect()}
        assert set(ids) <= {i * 50 for i in range(0, 12, 2)}
        tables = hard_negatives.subset_sums(np.array([[int(256 * size)] * 9], object))
        planes = hard_negatives.bit_planes(np.array([[-int(256 * size)] * 9]), 40)
        assert hard_negatives.scores(tables, planes).tolist() == [[-9 * int(256 * size) ** 2]]


def test_scores_equal_inner_products():
    draw = np.random.default_rng(2)
    a, b = draw.integers(-200, 200, (6, 21)), draw.integers(-128, 128, (50, 21))
    for kind in (np.int32, np.int64, object):
        found = hard_negatives.scores(hard_negatives.subset_sums(a.astype(kind)), hard_negatives.bit_planes(b, 8))
        assert (found == a @ b.T).all()


def test_negatives_without_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(hard_negatives.whole_vectors(none)).count() == 0
    one = spark.createDataFrame([(0, 1, [0.5], 1, 2, 3, 4, "r")], VECTORS)
    assert hard_negatives.mine(hard_negatives.whole_vectors(one)).count() == 0
    assert one.select(F.floor(F.element_at("embedding", 1) * 256.0)).first()[0] == 128
