"""The trie of conversations: a node for each different beginning, sums over subtrees.

A prefix is named by its depth and by four sums of 32-bit hashes of its turns and their
places, so running sums along each conversation name all its prefixes and no text moves.
The smallest conversation with a prefix, with the depth, is the node's key, and any
ancestor of a node is found as a row of that conversation.

Sums over subtrees come from a centroid decomposition of the parent edges. A component
is a connected part of the trie with a top. Its centroid is the deepest node that still
has half of the component's weight under it; a node weighs as many conversations as pass
through it, so at the start the weight under a node is known by counting rows. Taking the
centroid out leaves the parts under each of its children and the part above it. The
totals of the parts below make the centroid's sum, which is added to all nodes on the path
from it to the top, and each part is split again. Every part has half the weight at most,
so the rounds grow with the logarithm of the weight, however deep the trie is. Rounds run
in Spark while a component has more than ``part_nodes`` nodes; smaller components are
split to the end in tasks, many of them in one.

Defined cases: a null role or text is an empty one; a null turn comes before all others,
equal turns follow each other by role and then by the md5 of the text; rows with a null
conv_id belong to no conversation; a repeated row is another turn; further columns are
ignored; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored

#: A component of at most so many nodes is worked off in one task.
PART_NODES = 50_000
#: The rows of a prefix meet in so many pieces before they meet as a whole.
PIECES = 64

PREFIX = ("s0", "s1", "s2", "s3")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), a, b (hashes of role and text), bytes of the text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "md5")
    return (
        conversations.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
            F.md5(text).alias("md5"), F.octet_length(text).cast("long").alias("bytes"),
            F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        )
        .withColumn("place", F.row_number().over(order) - 1)
        .select("conv_id", "place", "a", "b", "bytes")
    )


def rebuilt(turns: DataFrame, stem: int = 5, most: int = 9) -> DataFrame:
    """Conversations put together anew: conv_id, depth (from 1), a, b, bytes, and length.

    Conversation c begins with the first h turns of conversation c - c % ``stem``, h being
    the crc32 of its id modulo ``most``; its own turns after its first h follow. One row
    of depth 0 stands for a conversation without any turn.
    """
    conv = F.col("conv_id")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (conv - conv % stem).alias("base"),
        F.pmod(F.crc32(conv.cast("string")), F.lit(most)).alias("h"),
    )
    lengths = own.select(conv.alias("base"), F.col("n").alias("base_n"))
    plan = own.join(lengths, "base", "left").select(
        "conv_id", "base", "h",
        F.least("h", F.coalesce("base_n", F.lit(0))).cast("int").alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).cast("int").alias("rest"),
    ).withColumn("length", F.col("taken") + F.col("rest"))
    late = turns.join(plan, "conv_id").where("place >= h").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).cast("int").alias("depth"),
        "a", "b", "bytes", "length",
    )
    early = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base").join(
        plan, "base"
    ).where("place < h").select(
        "conv_id", (F.col("place") + 1).cast("int").alias("depth"), "a", "b", "bytes", "length"
    )
    none = F.lit(0).cast("long")
    roots = plan.select(
        "conv_id", F.lit(0).alias("depth"), none.alias("a"), none.alias("b"), none.alias("bytes"), "length"
    )
    return late.unionByName(early).unionByName(roots)


def walks(turns: DataFrame) -> DataFrame:
    """Every conversation's way down the trie, a row per depth.

    conv_id, depth, length; node, the smallest conversation with this prefix; parent, that
    of the prefix before; n_convs, the conversations with the prefix; under, the weight of
    its subtree; bytes.
    """
    place = F.col("depth")
    down = Window.partitionBy("conv_id").orderBy("depth")

    def half(column: Column, upper: bool) -> Column:
        part = F.shiftrightunsigned(column, 32) if upper else column.bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(place == 0, 0).otherwise(part)

    made = [F.xxhash64(F.lit(3), place, "a"), F.xxhash64(F.lit(4), place, "b")]
    sums = [F.sum(half(made[i // 2], i % 2 == 1)).over(down).alias(name) for i, name in enumerate(PREFIX)]
    rows = stored(
        turns.select("conv_id", "depth", "length", "bytes", *sums)
        .withColumn("piece", F.pmod(F.xxhash64("conv_id"), F.lit(PIECES))),
        "trie-rows",
    )
    # A prefix may be in a third of all rows. Its pieces are counted first, then put
    # together, and the whole goes back to the pieces and from there to the rows.
    prefix = ["depth", *PREFIX]
    pieces = rows.groupBy(*prefix, "piece").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"),
        F.sum(F.col("length") - place + 1).alias("under"),
    )
    whole = pieces.groupBy(*prefix).agg(
        F.min("node").alias("node"), F.sum("n_convs").alias("n_convs"), F.sum("under").alias("under")
    )
    named = pieces.select(*prefix, "piece").join(whole, prefix)
    return rows.join(named, [*prefix, "piece"]).select(
        "conv_id", "depth", "length", "bytes", "node", "n_convs", "under",
        F.lag("node").over(down).alias("parent"),
    )


def ends(walk: DataFrame) -> DataFrame:
    """node, depth, ends_sha256 of nodes where conversations end.

    The digest is that of all their ids in order, so it is made in one go along sorted
    rows: a task holds one id at a time, however many there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, done = None, None, []
        for batch in batches:
            for node, depth, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (node, depth) != at:
                    if at:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (node, depth), hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            yield _ended(done)
            done = []
        yield _ended([(*at, digest.hexdigest())] if at else [])

    order = ["node", "depth", "conv_id"]
    last = walk.where("depth = length").select(*order)
    return last.repartition("node", "depth").sortWithinPartitions(*order).mapInArrow(
        run, "node long, depth int, ends_sha256 string"
    )


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("node", pa.int64()), ("depth", pa.int32()), ("ends_sha256", pa.string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)],
        [name for name, _ in kinds],
    )


def split_to_the_end(
    parents: list[int], weights: list[int], values: list[list[int]]
) -> list[list[int]]:
    """Sums over subtrees of a forest, by centroids.

    ``parents`` has -1 for tops, and a parent stands before its children. ``values`` has a
    list of numbers for each column; so has the result.
    """
    n, columns = len(parents), range(len(values))
    sums = [[0] * n for _ in columns]
    part = [0] * n  # the component a node is in now
    under, below = [0] * n, [[0] * n for _ in columns]
    todo: list[list[int]] = []
    tops: dict[int, int] = {}
    for v in range(n):
        if parents[v] < 0:
            tops[v] = len(todo)
            todo.append([])
        part[v] = tops[v] if parents[v] < 0 else part[parents[v]]
        todo[part[v]].append(v)
    fresh = len(todo)
    while todo:
        nodes = todo.pop()
        top, own = nodes[0], part[nodes[0]]
        for v in nodes:
            under[v] = weights[v]
            for k in columns:
                below[k][v] = values[k][v]
        for v in reversed(nodes):
            if v != top:
                under[parents[v]] += under[v]
                for k in columns:
                    below[k][parents[v]] += below[k][v]
        centroid = next(v for v in reversed(nodes) if 2 * under[v] >= under[top])
        for k in columns:
            sums[k][centroid] += below[k][centroid]
        v = centroid
        while v != top:  # from the centroid to the top
            v = parents[v]
            for k in columns:
                sums[k][v] += below[k][centroid]
        parts: dict[int, list[int]] = {}
        for v in nodes:
            if v == centroid:
                part[v] = -1
                continue
            if v != top and parents[v] == centroid:
                part[v] = fresh
                fresh += 1
            elif v != top and part[parents[v]] != own:
                part[v] = part[parents[v]]
            parts.setdefault(part[v], []).append(v)
        todo.extend(parts.values())
    return sums


_VALUES = ("leaves", "saved")


def _work_off(table: pa.Table) -> pa.Table:
    """All components of one group: node, depth, and sums with what rounds before have added."""
    order = table.sort_by([("depth", "ascending")])
    keys = list(zip(order["node"].to_pylist(), order["depth"].to_pylist(), strict=True))
    place = {key: i for i, key in enumerate(keys)}
    parents = [
        -1 if top else place[parent, depth - 1]
        for parent, (_, depth), top in zip(order["parent"].to_pylist(), keys, order["is_top"].to_pylist(), strict=True)
    ]
    sums = split_to_the_end(
        parents, order["n_convs"].to_pylist(), [order[name].to_pylist() for name in _VALUES]
    )
    return pa.table({
        "node": order["node"], "depth": order["depth"],
        **{
            name: pc.add(pa.array(inside, pa.int64()), order[f"add_{name}"])
            for name, inside in zip(_VALUES, sums, strict=True)
        },
    })


def rollup(nodes: DataFrame, walk: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """node, depth and, of leaves and saved, the sums over the node's subtree.

    ``nodes``: node, depth, parent, n_convs, under, leaves, saved. ``walk`` tells the
    nodes on each conversation's way: conv_id, depth, node, parent.
    """
    key, part = ["node", "depth"], ["top", "top_depth"]
    way = walk.select(
        F.col("conv_id").alias("on_way"), F.col("depth").alias("at"), F.col("node").alias("found"),
        F.col("parent").alias("found_parent"),
    )
    root = nodes.where("depth = 0").select("node").first()
    added = {name: F.lit(0).cast("long").alias(f"add_{name}") for name in _VALUES}
    columns = [*key, "parent", "n_convs", "under", *_VALUES, *[f"add_{name}" for name in _VALUES], *part]
    first = nodes.select(
        *columns[:7], *added.values(), F.lit(root and root["node"]).cast("long").alias("top"), F.lit(0).alias("top_depth")
    )
    live = stored(first, "trie-parts")
    small, finished = [], []
    while True:
        # A component's weight is what its top has under it, the most of all its nodes.
        sizes = live.groupBy(*part).agg(F.count("*").alias("n"), F.max("under").alias("weight"))
        large = stored(sizes.where(F.col("n") > part_nodes), "trie-large")
        small.append(live.join(large, part, "left_anti").select(*columns))
        if large.isEmpty():
            break
        live, done = _split(live.join(large.drop("n"), part), way, columns)
        finished.append(done)
    waiting = small[0]
    for frame in small[1:]:
        waiting = waiting.unionByName(frame)
    groups = nodes.count() // part_nodes + 1
    inside = (
        waiting.withColumn("is_top", (F.col("node") == F.col("top")) & (F.col("depth") == F.col("top_depth")))
        .groupBy(F.pmod(F.xxhash64(*part), F.lit(groups)).alias("group"))
        .applyInArrow(_work_off, "node long, depth int, leaves long, saved long")
    )
    for frame in finished:
        inside = inside.unionByName(frame)
    return inside


def _split(live: DataFrame, way: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round: every component without its centroid, and the centroids with their sums.

    ``live`` has the weight of each node's component.
    """
    key, part = ["node", "depth"], ["top", "top_depth"]
    # Nodes with half of the weight under them are one way down; its end is the centroid.
    heavy = F.when(2 * F.col("under") >= F.col("weight"), F.struct("depth", "node", "under"))
    centroids = live.groupBy(*part).agg(F.max(heavy).alias("c")).select(
        *part, F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.under").alias("c_under")
    )
    centroids = stored(centroids, "trie-centroids")
    below = F.coalesce(F.col("found_parent") == F.col("c_node"), F.lit(False))
    is_centroid = (F.col("node") == F.col("c_node")) & (F.col("depth") == F.col("c_depth"))
    marked = stored(
        live.join(centroids, part)
        .withColumn("next", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1))
        .join(way, F.expr("node = on_way and next = at"), "left")
        .withColumn("below", below)
        .withColumn("is_centroid", is_centroid)
        .select(*columns, "c_depth", "found", "below", "is_centroid"),
        "trie-marked",
    )
    totals = marked.where("below or is_centroid").groupBy(*part).agg(
        *[F.sum(name).alias(f"sum_{name}") for name in _VALUES]
    )
    settled = stored(centroids.join(totals, part), "trie-settled")
    path = settled.join(
        way, F.expr("on_way = c_node and at >= top_depth and at < c_depth")
    ).select(
        F.col("found").alias("node"), F.col("at").alias("depth"), "c_under",
        *[f"sum_{name}" for name in _VALUES],
    )
    none = F.lit(0)
    below_top = F.col("below")
    rest = marked.where("not is_centroid").join(path, key, "left").select(
        *key, "parent", "n_convs",
        (F.col("under") - F.coalesce("c_under", none)).alias("under"), *_VALUES,
        *[(F.col(f"add_{n}") + F.coalesce(f"sum_{n}", none)).alias(f"add_{n}") for n in _VALUES],
        F.when(below_top, F.col("found")).otherwise(F.col("top")).alias("top"),
        F.when(below_top, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
    )
    done = marked.where("is_centroid").join(settled.select(*part, *[f"sum_{n}" for n in _VALUES]), part).select(
        *key, *[(F.col(f"add_{n}") + F.col(f"sum_{n}")).alias(n) for n in _VALUES]
    )
    return stored(rest, "trie-parts"), stored(done, "trie-finished")


def trie(conversations: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations``.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    walk = stored(walks(rebuilt(stored(turns_of(conversations), "turns"))), "trie-walk")
    own = walk.where("conv_id = node").select("node", "depth", "parent", "n_convs", "under", "bytes")
    children = own.where("depth > 0").groupBy(
        F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = stored(
        own.join(children, ["node", "depth"], "left").select(
            "node", "depth", "parent", "n_convs", "under",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        ),
        "trie-nodes",
    )
    sums = rollup(nodes, walk, part_nodes)
    nobody = hashlib.sha256().hexdigest()
    return (
        nodes.drop("leaves", "saved").join(sums, ["node", "depth"])
        .join(ends(walk), ["node", "depth"], "left")
        .select(
            F.col("node").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
            F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
        )
    )
