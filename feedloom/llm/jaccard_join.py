"""N-gram Jaccard join by multiple global orders of the shingles.

Documents are sets of hashed word shingles. Under any global order of shingles, two sets
of similarity t or more share one within their prefixes, the first |A| - ceil(t |A|) + 1
each. Two orders are used, and candidates must share prefix shingles under both. An
order puts the shingles of one hash class first (about SHARE of all), the rare before the
frequent; frequencies are counted over all documents, in that class only, which is where
prefixes nearly always end. What is left of a short class is filled by hash.

1. Equal sets are one class, found by a digest; one document stands for each.
2. First order: shingles of the class are dealt by hash with the documents that have
   them. Those of one document only can link nothing: they take up prefix places and are
   dropped. Documents whose prefix is full of them are done.
3. The others come again with their whole sets; the second order is made of them, and
   documents without a shared prefix shingle there are done, too.
4. Links join documents to components. Where many documents share a prefix shingle, not
   all pairs are looked at: the documents of a shingle are compared with a hub first, the
   one with the smallest share of shingles of its own, which is nearest to what copies
   have in common. Then they are compared with a few that a hash draws, with STEP times as
   many, and so on to all; each time only pairs that share a shingle, but not yet a
   component, are candidates. Many near copies are one component after a few draws, and
   pairs in one component change nothing, so no link between components is lost. Pairs
   pass a bitmap first: sets differ in at least as many shingles as the parities of their
   shingles by BITS hash values do. Each is made at its first common shingle; the LOWEST
   smallest shingles of each prefix tell that nearly always, so rows stay short however
   long a prefix is, and what is made at a later one, too, is dropped as a repeat.

Shingles are dealt in blocks: what one batch has for a bucket of their hashes is one row, and
a task compares the shingles of one bucket at a time. A shingle that many documents of a batch
share is held once for the batch; the others who have it are sent after and only pass by.
Shingle hashes have 64 bits; similarities are exact counts of them.

Defined cases: a null text is an empty one; texts without words have an empty set, link
with nothing and are their own component; fewer words than WORDS are one shingle; null
doc_ids are documents like others, larger than any other; rows that repeat a doc_id and
text are linked, as are all rows of equal non-empty sets; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, stored, text_of

WORDS = 5
#: Similarity in hundredths: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Hash classes out of CLASSES that come first in an order.
CLASSES, FIRST = 8, 3
#: Length of the parity bitmap, a power of two of 64 at least.
BITS = 512
#: Shingles of a prefix that are carried along to know a pair's first common one.
LOWEST = 16
#: All pairs across components are looked at at once if they are so many for a member of a
#: token; else members are drawn, STEP times as many each time.
FEW_PAIRS, STEP = 4, 64
#: Rounds of labels between hubs; a hub and its copies need two.
LABELS = 2
CACHED_WORDS = 500_000
#: Shingles in one row of a bucket.
MOST_IN_ROW = 100_000
#: Bits for a document whose set is wanted whole, and for all of them; beyond, more texts
#: than those wanted come to the join that picks them.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 25

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


#: Shingles are dealt by their products with an odd number; its inverse gives them back.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, hashed: _WordHash) -> np.ndarray:
    """The set of shingles, sorted, as signed 64-bit hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    with np.errstate(over="ignore"):
        total = sum(codes[i : len(codes) - size + 1 + i] * _FACTORS[i] for i in range(size))
        total = total + np.uint64(size)
        total = (total ^ (total >> np.uint64(32))) * _FACTORS[1]
        total = (total ^ (total >> np.uint64(29))) * _FACTORS[2]
        total ^= total >> np.uint64(32)
    return np.unique(total.view(np.int64))


def prefix_length(size: int) -> int:
    """How many shingles of a set two similar sets must share one of."""
    return size - -(-size * SIMILAR // 100) + 1


def in_class(values: np.ndarray, order: int) -> np.ndarray:
    """Whether shingles are of the class that comes first in an order."""
    return (values.view(np.uint64) % np.uint64(CLASSES) + np.uint64(CLASSES - FIRST * order)) % np.uint64(CLASSES) < FIRST


def emitted(values: np.ndarray, order: int) -> np.ndarray:
    """The shingles among which a set's prefix under an order is: its first class, and so
    many others, by hash, as the prefix needs beyond it."""
    first = in_class(values, order)
    missing = prefix_length(len(values)) - int(first.sum())
    return values[first] if missing <= 0 else np.concatenate([values[first], values[~first][:missing]])


_KEY = pa.struct([("cls", pa.int64()), ("size", pa.int64())])
_TOKENS = pa.list_(pa.int64())
_SETS = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("cls", pa.int64()), ("size", pa.int64()), ("n", pa.int64()),
    ("emitted", _TOKENS),
])
#: Classes a task remembers in order not to emit their shingles again.
HELD_CLASSES = 200_000


def _class_of(values: np.ndarray, count: int) -> tuple[int, int]:
    """A set's class: 64 bits of a digest, with its size and the number it emits."""
    digest = hashlib.blake2b(values.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True), len(values) << 32 | count


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, key, class and size of the set of every text; what the class emits, unless
    this task has emitted it not long before."""
    hashed = _WordHash()
    known: set[tuple[int, int]] = set()
    for batch in sliced(batches):
        made = []
        for text in batch["text"].cast(pa.binary()).to_pylist():
            values = shingles(text, hashed)
            sent = emitted(values, 0)
            key = _class_of(values, len(sent))
            made.append((*key, len(values), None if key in known or not len(sent) else sent))
            if len(known) >= HELD_CLASSES:
                known.clear()
            known.add(key)
        cls, size, n, sent = zip(*made, strict=True) if made else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["key"], *(pa.array(x, pa.int64()) for x in (cls, size, n)), pa.array(list(sent), _TOKENS)],
            schema=_SETS,
        )


def _packed(columns: np.ndarray) -> bytes:
    """Rows of longs by planes of their bytes, so that a shuffle's compression drops high zeros."""
    return columns.view(np.uint8).reshape(*columns.shape, 8).transpose(0, 2, 1).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, 8, -1).transpose(0, 2, 1)
    return np.array(planes, order="C").view(np.int64)[..., 0]


def _blocks(buckets: int, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """bucket, late, data: the emitted shingles of every class, dealt by hash, a row for each
    bucket of a batch. Its first row has each shingle once, with one class and how many of
    the batch have it; ``late`` rows have the other classes."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        count = 0
        for batch in batches:
            cls, size = batch["cls"].to_numpy(), batch["size"].to_numpy()
            values = batch["emitted"].flatten().to_numpy()
            ends = np.cumsum(batch["emitted"].value_lengths().to_numpy())
            for i, key in enumerate(zip(cls.tolist(), size.tolist(), strict=True)):
                if key not in held:
                    held[key] = values[ends[i - 1] if i else 0 : ends[i]]
                    count += len(held[key])
            if count > 1 << 21:
                yield from _dealt(held, buckets, order)
                held, count = {}, 0
        yield from _dealt(held, buckets, order)

    return blocks


def _dealt(held: dict[tuple[int, int], np.ndarray], buckets: int, order: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    lengths = np.fromiter(map(len, held.values()), np.int64, len(held))
    keys = np.array(list(held), np.int64)
    mixed = np.concatenate(list(held.values())).view(np.uint64)
    mixed *= _MIX
    by = np.argsort(mixed, kind="stable")
    mixed = mixed[by]
    owners = np.repeat(np.arange(len(held), dtype=np.int32), lengths)[by]
    del by
    begins = np.append(True, mixed[1:] != mixed[:-1])
    made = []
    for late, rows in ((False, np.flatnonzero(begins)), (True, np.flatnonzero(~begins))):
        if not len(rows):
            continue
        counts = np.zeros(len(rows), np.int64) if late else np.diff(rows, append=len(mixed))
        # Both factors are below 2 ** 32; the bucket grows with the mixed shingle.
        bucket = (mixed[rows] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        starts = np.union1d(starts, np.arange(0, len(rows), MOST_IN_ROW))
        bucket = bucket[starts].tolist()
        for i, (start, end) in enumerate(zip(starts, np.append(starts[1:], len(rows)), strict=True)):
            tokens, owner = mixed[rows[start:end]], owners[rows[start:end]]
            count = counts[start:end] + (lengths[owner] << 32) if order else counts[start:end]
            deltas = np.diff(tokens, prepend=np.uint64(0)).view(np.int64)
            made.append((bucket[i], late, _packed(np.stack([deltas, keys[owner, 0], keys[owner, 1], count]))))
            if len(made) == 512:
                yield _block_rows(made)
                made = []
    if made:
        yield _block_rows(made)


def _block_rows(made: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(zip(*made, strict=True), kinds, strict=True)], ["bucket", "late", "data"]
    )


def _shared_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """token, frequency, cls, size, m of the shingles that more than one class has; rows come
    by bucket, the late ones last. Only the others of one bucket are held."""
    now, first, known, out = None, [], None, []
    for batch in batches:
        for bucket, late, data in zip(*(batch[c].to_pylist() for c in ("bucket", "late", "data")), strict=True):
            if bucket != now:
                if first:
                    out.append(_shared_rows(first)[1])
                now, first, known = bucket, [], None
            rows = _unpacked(data)
            rows[0] = np.cumsum(rows[0].view(np.uint64)).view(np.int64)
            if not late:
                first.append(rows)
                continue
            if first:
                known, own = _shared_rows(first)
                out.append(own)
                first = []
            frequency = known[1][np.searchsorted(known[0], rows[0].view(np.uint64))]
            out.append(np.stack([rows[0], frequency, rows[1], rows[2], rows[3] >> 32]))
            if sum(x.shape[1] for x in out) > 50_000:
                yield from _token_rows(out)
                out = []
        yield from _token_rows(out)
        out = []
    if first:
        yield from _token_rows([_shared_rows(first)[1]])


def _shared_rows(first: list[np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The shared mixed shingles of a bucket with their frequencies, and their rows."""
    rows = np.concatenate(first, axis=1)
    rows = rows[:, np.argsort(rows[0].view(np.uint64), kind="stable")]
    starts = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1]))
    number = rows[3] & 0xFFFFFFFF
    frequency = np.add.reduceat(number, starts)
    differ = [np.minimum.reduceat(x, starts) < np.maximum.reduceat(x, starts) for x in rows[1:3]]
    shared = (np.maximum.reduceat(number, starts) > 1) | differ[0] | differ[1]
    each = np.diff(np.append(starts, rows.shape[1]))
    kept = rows[:, np.repeat(shared, each)]
    known = rows[0, starts].view(np.uint64)[shared], frequency[shared]
    return known, np.stack([kept[0], np.repeat(known[1], each[shared]), kept[1], kept[2], kept[3] >> 32])


_SHARED = ["token", "frequency", "cls", "size", "m"]


def _token_rows(out: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate(out, axis=1) if out else np.empty((5, 0), np.int64)
    rows[0] = (rows[0].view(np.uint64) * _UNMIX).view(np.int64)
    for i in range(0, rows.shape[1], 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in rows], _SHARED)


def parities(values: np.ndarray) -> np.ndarray:
    """For each hash value below BITS the parity of its shingles, as 64-bit words."""
    place = (values.view(np.uint64) >> np.uint64(65 - BITS.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cls, size, tokens, second (emitted under the second order) and bits, each class once
    a batch."""
    hashed = _WordHash()
    for batch in sliced(batches):
        made = {}
        for text in batch["text"].cast(pa.binary()).to_pylist():
            values = shingles(text, hashed)
            made.setdefault(_class_of(values, len(emitted(values, 0))), values)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([key[i] for key in made], pa.int64()) for i in (0, 1)),
                pa.array(list(made.values()), longs),
                pa.array([emitted(values, 1) for values in made.values()], longs),
                pa.array([parities(values) for values in made.values()], longs),
            ],
            ["cls", "size", "tokens", "second", "bits"],
        )


def buckets_for(tokens: int) -> int:
    """Into how many buckets so many shingles are dealt: small ones while they are few, and
    few enough that a batch's share of one is more than a few shingles."""
    return max(1, min(tokens >> 13, 1 << 13), tokens >> 20)


def _shared(emitted: DataFrame, order: int) -> DataFrame:
    """token, frequency, cls, size, m (how many the class emits, under the second order) of
    all shingles that several classes emit; a class may come more than once."""
    low_bits = F.col("size").bitwiseAND(F.lit((1 << 32) - 1))
    buckets = buckets_for(emitted.agg(F.sum(low_bits)).first()[0] or 0)
    return (
        emitted.where("emitted is not null").select("cls", "size", "emitted")
        .mapInArrow(_blocks(buckets, order), "bucket int, late boolean, data binary")
        .repartition("bucket").sortWithinPartitions("bucket", "late")
        .mapInArrow(_shared_of, "token long, frequency long, cls long, size long, m long")
    )


def _prefixes(emitted: DataFrame, order: int) -> DataFrame:
    """node, lone, prefix: the shared shingles of each node's prefix, and the share of those
    it emits that it has alone. Those of one node only take the first places of its prefix.

    ``emitted``: cls, size and the emitted shingles of each node.
    """
    return _shared(emitted, order).repartition("cls", "size").sortWithinPartitions("cls", "size").mapInArrow(
        _cut(order), "node struct<cls:bigint,size:bigint>, lone double, prefix array<bigint>"
    )


def _cut(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Prefixes under an order of shared shingles that come by node."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch[c].to_numpy() for c in _SHARED])
            changes = np.flatnonzero((rows[2:4, 1:] != rows[2:4, :-1]).any(axis=0)) + 1
            if held and (held[-1][2:4, -1] != rows[2:4, 0]).any():
                changes = np.append(0, changes)
            if not len(changes):
                held.append(rows)
                continue
            whole = [*held, rows[:, : changes[-1]]]
            held = [rows[:, changes[-1] :]]
            yield _prefix_rows(np.concatenate(whole, axis=1), order)
        if held:
            yield _prefix_rows(np.concatenate(held, axis=1), order)

    return cut


def _prefix_rows(rows: np.ndarray, order: int) -> pa.RecordBatch:
    """Sorts shingles as the global order does: first class, rare before frequent, hash."""
    node = np.cumsum(np.append(False, (rows[2:4, 1:] != rows[2:4, :-1]).any(axis=0)))
    later = ~in_class(rows[0], order)
    by = np.lexsort((rows[0], np.where(later, 0, rows[1]), later, node))
    rows, node = rows[:, by], node[by]
    again = np.append(False, (rows[0, 1:] == rows[0, :-1]) & (node[1:] == node[:-1]))
    rows, node = rows[:, ~again], node[~again]
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    several = np.diff(np.append(starts, len(node)))
    size = rows[3, starts]
    m = rows[4, starts] if order else size & 0xFFFFFFFF
    places = np.clip(prefix_length(size >> 32) - (m - several), 0, several)
    tokens = rows[0, np.arange(len(node)) - starts[node] < places[node]]
    some = places > 0
    bounds = np.append(0, np.cumsum(places[some])).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.StructArray.from_arrays([pa.array(rows[2, starts][some]), pa.array(size[some])], fields=list(_KEY)),
            pa.array(1 - several[some] / m[some]),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(tokens)),
        ],
        ["node", "lone", "prefix"],
    )


def _maybe(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose key has its bit among those of the wanted keys: all that are wanted, and
    few others, so that few texts or sets are shuffled."""
    bits, enough = 64, min(FILTER_BITS * wanted.count(), MOST_FILTER_BITS)
    while bits < enough:
        bits *= 2
    word = F.shiftright(F.pmod("key", F.lit(bits)), 6).alias("word")
    place = F.col("key").bitwiseAND(F.lit(63)).cast("int")
    words = wanted.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("set"))
    return (
        rows.withColumn("word", word).join(F.broadcast(words), "word")
        .where(F.getbit("set", place) == 1).drop("word", "set")
    )


def _fits(a: Column, b: Column) -> Column:
    """Whether sizes allow two nodes to be similar."""
    one, other = F.shiftright(a["size"], 32), F.shiftright(b["size"], 32)
    return (F.least(one, other) * 100 >= F.greatest(one, other) * SIMILAR) & (a != b)


def _verified(pairs: DataFrame, second: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar; those without a common prefix shingle under the
    second order are dropped before their sets are fetched."""
    side = lambda frame, name, column: frame.select(
        F.col("node").alias(name), F.col(column).alias(f"{column}_{name}")
    )
    second = _maybe(second.withColumn("key", F.xxhash64("node")), _ends(pairs))
    likely = stored(
        pairs.join(side(second, "a", "prefix"), "a").join(side(second, "b", "prefix"), "b")
        .where(F.arrays_overlap("prefix_a", "prefix_b")).select("a", "b"), "jaccard-likely",
    )
    sets = _maybe(sets.withColumn("key", F.xxhash64("node")), _ends(likely))
    both = likely.join(side(sets, "a", "tokens"), "a").join(side(sets, "b", "tokens"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - common
    return both.where(common * 100 >= union * SIMILAR).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    """key (hash) of each node of pairs (a, b)."""
    key = lambda name: pairs.select(F.xxhash64(name).alias("key"))
    return stored(key("a").union(key("b")).distinct(), "jaccard-ends")


def components(links: DataFrame, label: str = "jaccard-labels", rounds: int | None = None) -> DataFrame:
    """node, part: the smallest node reachable by links (a, b), for all that have one.

    Labels go to neighbours, and then to whoever has the label's owner as a label, until
    none changes; the second step makes long chains short. ``links`` is read once a round,
    so it should be stored. With ``rounds``, no more than so many: nodes of one label are
    connected then, too, but connected ones may still have several.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    parts = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("part")), label,
    )
    for n in count(1):
        of = lambda name: parts.select(F.col("node").alias(name), F.col("part").alias(f"part_{name}"))
        nearest = both.join(of("b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("part_b").alias("near"))
        better = (
            parts.join(nearest, "node").select("node", "part", F.least("part", "near").alias("now"))
            .join(of("now"), "now", "left")
            .select("node", F.col("part").alias("was"), F.least("now", F.coalesce("part_now", "now")).alias("part"))
        )
        better = stored(better, label)
        parts = better.select("node", "part")
        if n == rounds or better.where("was != part").isEmpty():
            return parts


def _linked(members: DataFrame, first: DataFrame, second: DataFrame, sets: DataFrame) -> DataFrame:
    """node, part: the components that similar members (token, node, rank, n) of a token make.

    The member with the smallest ``rank`` of a token's ``n`` is the hub. What is in one
    component already is only known in order to leave out pairs, so until the end LABELS
    rounds are enough. Draws are for tokens of many members, so the others, which have most
    of the rows, only come in the end, when all pairs across components are looked at.
    """
    hubs = members.groupBy("token").agg(F.min(F.struct("rank", "node")).alias("hub"))
    pairs = members.join(hubs, "token").where(F.col("node") != F.col("hub.node")).select(
        F.col("node").alias("a"), F.col("hub.node").alias("b")
    )
    links = _add_links(None, pairs, second, sets)
    words = [F.col("bits")[i].alias(f"bits{i}") for i in range(BITS // 64)]
    low = lambda tokens: F.slice(F.sort_array(tokens), 1, LOWEST).alias("low")
    known = stored(
        first.select("node", low(F.col("prefix"))).join(sets.select("node", *words), "node")
        .join(members.select("node").distinct(), "node", "left_semi"), "jaccard-known",
    )
    if (members.agg(F.max("n")).first()[0] or 0) >= 4 * STEP:
        now, main = _apart(_many(members, STEP), links)
        share = first_share(*main.agg(F.max("all"), F.sum(F.col("outside") * F.col("all")), F.sum("all")).first())
        while share > 1:
            # A pair's first common shingle must be one of those that come now.
            lowest = now.groupBy("node").agg(low(F.collect_list("token")))
            links = _add_links(links, _across(now, main, known.drop("low").join(lowest, "node"), share), second, sets)
            share //= STEP
            if share > 1:
                now, main = _apart(_many(members, share), links)
    now, main = _apart(members, links)
    return components(_add_links(links, _across(now, main, known, 1), second, sets))


def _many(members: DataFrame, share: int) -> DataFrame:
    """Members of the tokens of which at least half a member is drawn, if one in ``share`` is."""
    return members.where(F.col("n") * 2 >= share)


def _apart(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """token, node, part of the members, and, of the tokens that have several parts, token,
    main (the largest part), all (members) and how many of them are outside of it."""
    now = stored(
        members.join(components(links, rounds=LABELS), "node", "left")
        .select("token", "node", F.coalesce("part", "node").alias("part")),
        "jaccard-members",
    )
    main = (
        now.groupBy("token", "part").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("token").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("all"))
        .select("token", F.col("most.part").alias("main"), "all", (F.col("all") - F.col("most.n")).alias("outside"))
        .where("outside > 0")
    )
    return now, stored(main, "jaccard-main")


def first_share(most: int | None, pairs: int | None, members: int | None) -> int:
    """One member in how many is compared with first: so that the token with ``most``
    members has 4 such at least; all of them, if that makes few pairs."""
    share = 1
    if (pairs or 0) > FEW_PAIRS * (members or 0):
        while most >= 4 * share * STEP:
            share *= STEP
    return share


def _across(now: DataFrame, main: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) of members of a token that are not in one component and pass the bitmap;
    b is one of the members that a hash draws, one in ``share``."""
    drawn = lambda node: F.pmod(F.xxhash64(node), F.lit(share)) == 0
    detail = stored(
        now.join(main.select("token", "main"), "token")
        .withColumn("inside", F.col("part") == F.col("main")).drop("main")
        .where(~F.col("inside") | drawn("node")).join(known, "node"), "jaccard-cross"
    )
    x, y = (detail.select([F.col(c).alias(f"{c}_{side}") for c in detail.columns]) for side in "xy")
    differ = sum(
        F.bit_count(F.col(f"bits{i}_x").bitwiseXOR(F.col(f"bits{i}_y"))) for i in range(BITS // 64)
    )
    both = F.shiftright(F.col("node_x.size"), 32) + F.shiftright(F.col("node_y.size"), 32)
    return x.where(~F.col("inside_x")).join(
        y.where(drawn("node_y")),
        (F.col("token_x") == F.col("token_y")) & (F.col("part_x") != F.col("part_y"))
        & (F.col("inside_y") | (F.col("node_x") < F.col("node_y")) | ~drawn("node_x"))
        & _fits(F.col("node_x"), F.col("node_y"))
        & (both * (100 - SIMILAR) >= differ * (100 + SIMILAR))
        & (F.coalesce(F.array_min(F.array_intersect("low_x", "low_y")), F.col("token_x")) >= F.col("token_x")),
    ).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def _add_links(
    links: DataFrame | None, pairs: DataFrame, second: DataFrame, sets: DataFrame
) -> DataFrame:
    """All links, with those among the pairs."""
    pairs = stored(pairs.where(_fits(F.col("a"), F.col("b"))).distinct(), "jaccard-pairs")
    found = stored(_verified(pairs, second, sets), "jaccard-links")
    return found if links is None else links.unionByName(found)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), n_shingles, component_id of every row, and
    ``keep``: whether it is the one of its component that has the smallest doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    narrow = stored(
        rows.mapInArrow(_sets, "doc_id long, key long, cls long, size long, n long, emitted array<long>"),
        "jaccard-sets", **{"parquet.enable.dictionary#emitted.list.element": "false"},
    )
    first = stored(_prefixes(narrow, 0), "jaccard-first")
    narrow = narrow.drop("emitted")
    spread = first.select("node", F.col("lone").alias("rank"), F.explode("prefix").alias("token"))
    several = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(spread.join(several, "token").select("token", "node", "rank", "n"), "jaccard-members")

    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = stored(
        narrow.where("n > 0").groupBy(F.struct("cls", "size").alias("node")).agg(F.min(place).alias("place")), "jaccard-classes"
    )
    wanted = stored(members.select("node").distinct().join(classes, "node").select(
        F.coalesce("place.doc_id", F.lit(0)).alias("of"), F.col("place.none").alias("none"),
        F.col("place.key").alias("key"),
    ), "jaccard-wanted")
    texts = _maybe(rows, wanted).withColumn("of", F.coalesce("doc_id", F.lit(0))).withColumn("none", F.isnull("doc_id"))
    sets = texts.join(wanted, ["of", "none", "key"], "left_semi").select("text").mapInArrow(
        _whole_sets, "cls long, size long, tokens array<long>, second array<long>, bits array<long>"
    )
    sets = stored(sets, "jaccard-tokens")
    if not sets.groupBy("cls", "size").count().where("count > 1").isEmpty():
        sets = stored(sets.dropDuplicates(["cls", "size"]), "jaccard-tokens")  # repeated rows
    second = stored(_prefixes(sets.withColumnRenamed("second", "emitted"), 1), "jaccard-second")
    parts = _linked(
        members, first, second, sets.select(F.struct("cls", "size").alias("node"), "tokens", "bits")
    )

    labelled = classes.join(parts, "node", "left").select(
        "node", "place", F.coalesce("part", "node").alias("part")
    )
    least = labelled.groupBy("part").agg(F.min("place").alias("first"))
    of_class = labelled.join(least, "part").select(
        F.col("node.cls").alias("cls"), F.col("node.size").alias("size"), "first"
    )
    return narrow.join(of_class, ["cls", "size"], "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (place == F.col("first"))).alias("keep"),
    )


def survivors(docs: DataFrame) -> DataFrame:
    """One row of each group, all columns of ``docs``; every row whose set is empty."""
    ident = lambda doc_id, key: F.concat_ws(":", doc_id.cast("string"), key.cast("string"))
    kept = groups(docs).where("keep").select(
        ident(F.col("doc_id"), F.col("key")).alias("_key"), (F.col("n_shingles") == 0).alias("_empty")
    ).distinct()
    rows = docs.select(
        F.struct("*").alias("_row"),
        ident(F.col("doc_id").cast("long"), F.xxhash64(text_of())).alias("_key"),
    ).join(kept, "_key")
    own = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("_row")))
    return rows.withColumn("_n", own).where("_empty or _n = 1").select("_row.*")
