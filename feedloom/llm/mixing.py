"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words. A document's expected copies are its source's target
over its source's size; the whole part is settled, the fraction is a mass between none
and all of the document's words. Pivotal rounding pairs two documents of a source and
moves mass from one to the other, in a random direction with the odds that leave both
expectations as they are, until one of them is at none or all. What is moved are words,
so a pair's words stay the same, and a source misses its target by less than one document.

The pairs form a reduction tree: rows are dealt by hash into groups of ``FAN_IN``, each
group is folded to one open document and many settled ones, and the open ones are folded
again, until one is left for each source, which is rounded by a last draw. Groups have a
fixed size, so a hot source only has more of them. Draws are hashes of the documents'
ids and sizes, hence reruns agree.

Defined cases: a null or empty text has size 0, takes 0 words and counts as a document; a
null source is a source of its own, the last one; null and repeated doc_ids are rows like
others, and rows that repeat another can be swapped with it; further columns are ignored
(``mix`` keeps them); an empty table gives no rows; sources without words get target 0.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored

#: Weights dealt to the sources in order, again and again; share of all words to take;
#: the most copies of a document. Fixed by the task.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
FAN_IN = 64
#: Rows of a source are dealt to so many hash buckets of this expected size first.
BUCKET = 4096
WORDS = "[^\\x20\\x09-\\x0D]+"


def size_of(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, n, target for each source of ``sizes`` (source, size).

    A target stops at ``most`` times its source's size; what is cut goes to the others
    by weight, until none is above. Each round takes two sums from a table that has one
    row per source, and only those come to the driver.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1
    )
    per_source = stored(per_source.withColumn("weight", weight), "mix-sources")
    total = per_source.agg(F.sum("source_size")).first()[0] or 0
    level, cap = 0.0, F.col("source_size") * F.lit(most)
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        left, open_weight = per_source.agg(
            F.lit(share * total) - F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if not open_weight or left / open_weight <= level:
            break
        level = left / open_weight
    return per_source.select(
        "source", "source_size", "n",
        F.least(cap, F.col("weight") * F.lit(level)).cast("double").alias("target"),
    )


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def _with_mass(item: Column, mass: Column) -> Column:
    return item.withField("mass", mass)


def _fold(items: Column, level: int, seed: int) -> Column:
    """The one open item of a group, and all others settled: their mass is none or all."""

    def step(state: Column, new: Column) -> Column:
        old = state["open"]
        old_room, new_room = old["size"] - old["mass"], new["size"] - new["mass"]
        gain, loss = F.least(old_room, new["mass"]), F.least(old["mass"], new_room)
        up = _draw(old["tag"], new["tag"], F.lit(level), F.lit(seed)) * (gain + loss) < loss
        # Ends are set, not computed: a settled mass equals none or all to the last bit.
        old_mass = (
            F.when(up, F.when(gain == old_room, old["size"]).otherwise(old["mass"] + gain))
            .when(loss == old["mass"], F.lit(0.0))
            .otherwise(old["mass"] - loss)
        )
        new_mass = (
            F.when(up, F.when(gain == new["mass"], F.lit(0.0)).otherwise(new["mass"] - gain))
            .when(loss == new_room, new["size"])
            .otherwise(new["mass"] + loss)
        )
        old, new = _with_mass(old, old_mass), _with_mass(new, new_mass)
        settled = (old_mass == 0) | (old_mass == old["size"])
        return F.struct(
            F.when(settled, new).otherwise(old).alias("open"),
            F.concat(state["done"], F.array(F.when(settled, old).otherwise(new))).alias("done"),
        )

    first = F.struct(F.element_at(items, 1).alias("open"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(F.slice(items, F.lit(2), F.size(items)), first, step)


def _level(items: DataFrame, level: int, seed: int) -> DataFrame:
    """``items`` (source, item) dealt into groups of FAN_IN at most, and these folded."""
    counts = items.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("source").alias("of"), "n"
    )
    by_hash = F.pmod(F.xxhash64("item.tag", F.lit(level)), F.ceil(F.col("n") / BUCKET))
    order = Window.partitionBy("source", "bucket").orderBy("item.size", "item.tag")
    groups = (
        items.join(counts, F.col("source").eqNullSafe(F.col("of")))
        .select("source", by_hash.alias("bucket"), "item")
        .withColumn("slot", F.floor((F.row_number().over(order) - 1) / FAN_IN))
        .groupBy("source", "bucket", "slot")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return stored(
        groups.select("source", _fold(F.col("items"), level, seed).alias("state")), f"mix-{level}"
    )


def mixture(rows: DataFrame, seed: int = 0, **choices) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for each row of ``rows``.

    ``rows``: doc_id (of any type), source, size. ``copies`` is how often the mix has the row.
    """
    rows = stored(
        rows.select("doc_id", "source", F.col("size").cast("long").alias("size")), "mix-rows"
    )
    targets = stored(source_targets(rows, **choices), "mix-targets").select(
        F.col("source").alias("of"), "source_size", "target"
    )
    same_source = F.col("source").eqNullSafe(F.col("of"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    items = rows.join(targets, same_source).select(
        "source",
        F.struct(
            F.col("size").cast("double").alias("size"),
            F.xxhash64("doc_id", "size", F.lit(seed)).alias("tag"),
            F.col("doc_id").alias("id"),
            F.floor(expected).alias("base"),
            ((expected - F.floor(expected)) * F.col("size")).alias("mass"),
        ).alias("item"),
    )
    settled, level = [], 0
    while True:
        level += 1
        state = _level(items, level, seed)
        settled.append(state.select("source", F.explode("state.done").alias("item")))
        items = state.select("source", F.col("state.open").alias("item"))
        if items.groupBy("source").count().where("count > 1").isEmpty():
            break
    # One open document is left for each source.
    drawn = _draw(F.col("item.tag"), F.lit(seed)) * F.col("item.size") < F.col("item.mass")
    settled.append(items.withColumn(
        "item", _with_mass(F.col("item"), F.when(drawn, F.col("item.size")).otherwise(0.0))
    ))
    whole = functools.reduce(DataFrame.unionByName, settled).join(targets, same_source)
    item, fraction = F.col("item"), expected - F.floor(expected)
    extra = F.when(item["size"] > 0, item["mass"] == item["size"]).otherwise(
        _draw(item["tag"], F.lit(seed)) < fraction  # without words there is no mass to move
    )
    return whole.select(
        item["id"].alias("doc_id"), "source", item["size"].cast("long").alias("size"),
        "source_size", "target", (item["base"] + extra.cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, seed: int = 0, **choices) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, source, text and more), each as often as
    the mixture has it."""
    names = docs.columns
    # Rows that repeat another in all columns are one row with a count until the end.
    packed = docs.groupBy(*names).agg(F.count(F.lit(1)).alias("_times"))
    packed = packed.select(
        F.struct(*names).alias("_row"), "_times",
        F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256).alias("_key"),
    )
    keys = packed.select(
        F.col("_key").alias("doc_id"), F.col("_row.source").alias("source"),
        size_of(F.col("_row.text")).alias("size"), F.explode(F.sequence(F.lit(1), F.col("_times"))),
    )
    copies = (
        mixture(keys, seed, **choices)
        .groupBy(F.col("doc_id").alias("_key"))
        .agg(F.sum("copies").alias("_copies"))
        .where("_copies > 0")
    )
    return packed.join(copies, "_key").select(
        F.explode(F.array_repeat("_row", F.col("_copies").cast("int"))).alias("_row")
    ).select("_row.*")
