"""Language identification by a convolutional network over bytes.

Bytes are first folded to classes (letters without case, one class each for digits,
punctuation and white space, bytes of other characters as they are). Filters of several
widths slide over windows of fixed length; each filter's largest response in the window
goes, rectified, to a softmax layer. A document's probability is the mean of the log
probabilities of all its windows, weighted by their bytes, so whole texts count.

Training is numpy on the driver, over a bounded sample: about PER_LANGUAGE documents of
each language, chosen by hash, with WINDOWS windows each. On a one-hot input a filter is
a table by class, which makes training sparse; to apply it, the tables of neighbouring
bytes are added up beforehand, and two look-ups give all filters at a place.

Defined cases: a null text or one without any letter is ``und`` with score 0, and so is
every text if there is nothing to learn from; an empty text has no letter; rows without a
language are never learnt from; a null doc_id hashes as an empty text; ties go to the
first language by name; repeated rows have equal results; further columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
#: The bound of the sample: documents per language (on average), windows of each.
PER_LANGUAGE = 1500
WINDOWS = 2
EPOCHS = 4
UNKNOWN = "und"


def _fold() -> np.ndarray:
    """Class of each byte; 0 is padding."""
    classes = np.full(256, 1, np.int32)  # controls and punctuation
    for byte in range(256):
        char = chr(byte)
        if byte >= 0x80:
            classes[byte] = 30 + byte - 0x80
        elif char.isspace():
            classes[byte] = 2
        elif char.isdigit():
            classes[byte] = 3
        elif char.isalpha():
            classes[byte] = 4 + ord(char.lower()) - ord("a")
    return classes


FOLD = _fold()
CLASSES = 30 + 0x80


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Classes in rows of WINDOW, the last padded, and the number of bytes of each row."""
    classes = FOLD[np.frombuffer(data, np.uint8)]
    rows = max(1, -(-len(classes) // WINDOW))
    padded = np.zeros(rows * WINDOW, np.int32)
    padded[: len(classes)] = classes
    sizes = np.full(rows, WINDOW)
    sizes[-1] = max(1, len(classes) - (rows - 1) * WINDOW)
    return padded.reshape(rows, WINDOW), sizes


@dataclass
class Network:
    """Filters by width (width, class, filter), softmax weights, and language names."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 0) -> Network:
        draw = np.random.default_rng(seed)
        pooled = FILTERS * len(WIDTHS)
        return cls(
            languages,
            [draw.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(pooled, np.float32),
            draw.normal(0, 0.2, (pooled, len(languages))).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.weights, self.offset]

    def responses(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each row, and where it is."""
        best, places = [], []
        for width, table in zip(WIDTHS, self.filters, strict=True):
            reach = WINDOW - width + 1
            total = sum(table[k][rows[:, k : k + reach]] for k in range(width))
            at = total.argmax(axis=1)
            places.append(at)
            best.append(np.take_along_axis(total, at[:, None], axis=1)[:, 0])
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(places, axis=1)

    def train(self, rows: np.ndarray, target: np.ndarray, epochs: int, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        share = np.bincount(target, minlength=len(self.languages)) / len(target)
        weight = (1 / (share * len(self.languages)).clip(1e-6))[target].astype(np.float32)
        memory = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for _ in range(epochs):
            for batch in np.array_split(draw.permutation(len(rows)), -(-len(rows) // 64)):
                step += 1
                for p, g, (m, v) in zip(
                    self.parameters(), self.gradients(rows[batch], target[batch], weight[batch]),
                    memory, strict=True,
                ):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def gradients(self, rows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        pooled, places = self.responses(rows)
        active = np.maximum(pooled, 0)
        error = np.exp(log_softmax(active @ self.weights + self.offset))
        error[np.arange(len(target)), target] -= 1
        error *= weight[:, None] / len(target)
        back = (error @ self.weights.T) * (pooled > 0)
        made = []
        for i, width in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            grad = np.zeros_like(self.filters[i])
            filters = np.broadcast_to(np.arange(FILTERS), places[:, own].shape)
            for k in range(width):
                classes = np.take_along_axis(rows, places[:, own] + k, axis=1)
                np.add.at(grad[k], (classes, filters), back[:, own])
            made.append(grad)
        return [*made, back.sum(0), active.T @ error, error.sum(0)]


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


class Applied:
    """A network made ready for many windows."""

    ROWS = 64

    def __init__(self, network: Network):
        two, three, four = network.filters
        add = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(CLASSES**2, FILTERS)
        none = np.zeros((CLASSES, FILTERS), np.float32)
        # For the pair at a place, and for the pair two places further on.
        self.here = np.concatenate([add(two[0], two[1]), add(three[0], three[1]), add(four[0], four[1])], 1)
        self.there = np.concatenate([add(three[2], none), add(four[2], four[3])], 1)
        self.network = network

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        pairs = rows[:, :-1] * CLASSES + rows[:, 1:]
        here = self.here.take(pairs, axis=0, mode="clip")
        # A filter of three ends one place earlier than the pairs further on: pad once.
        there = self.there.take(pairs[:, 2:], axis=0, mode="clip")
        both = here[:, :-2, FILTERS:]
        both += there
        edge = here[:, -2, FILTERS : 2 * FILTERS] + self.there.take(
            rows[:, -1] * CLASSES, axis=0, mode="clip"
        )[:, :FILTERS]
        best = np.concatenate([here[:, :, :FILTERS].max(1), both.max(1)], 1)
        mid = slice(FILTERS, 2 * FILTERS)
        best[:, mid] = np.maximum(best[:, mid], edge)
        return best + self.network.bias

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = [
            np.maximum(self.pooled(rows[i : i + self.ROWS]), 0) @ self.network.weights
            for i in range(0, len(rows), self.ROWS)
        ]
        return log_softmax(np.concatenate(out) + self.network.offset)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The place of the likeliest language, and its probability, for each text."""
        cut = [windows_of(text) for text in texts]
        logs = self.log_probabilities(np.concatenate([rows for rows, _ in cut]))
        sizes = np.concatenate([size for _, size in cut])
        first = np.append(0, np.cumsum([len(size) for _, size in cut]))[:-1]
        total = np.add.reduceat(logs * sizes[:, None], first) / np.add.reduceat(sizes, first)[:, None]
        final = np.exp(log_softmax(total))
        return final.argmax(1), final.max(1)


def learn(labelled: DataFrame, seed: int = 0) -> Network | None:
    """A network trained on a bounded sample of ``labelled`` (doc_id, text, lang)."""
    labelled = labelled.where("lang is not null and text is not null")
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().toLocalIterator()}
    languages = sorted(counts)
    if not languages:
        return None
    chance = F.create_map(*[
        F.lit(x) for name in languages for x in (name, min(1.0, PER_LANGUAGE / counts[name]))
    ])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    start = lambda i: F.pmod(
        F.xxhash64("doc_id", F.lit(seed + i)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1)).cast("long")
    )
    sample = labelled.where(draw < chance[F.col("lang")]).select(
        "lang",
        F.array(*[F.substring("text", (start(i) + 1).cast("int"), F.lit(WINDOW)) for i in range(1, WINDOWS + 1)]).alias("cut"),
    )
    rows, target = [], []
    for row in sample.orderBy("lang", "cut").toLocalIterator():
        for text in row["cut"]:
            if any(map(str.isalpha, text)):
                rows.append(windows_of(text.encode()[:WINDOW])[0])
                target.append(languages.index(row["lang"]))
    if not rows:
        return None
    network = Network.fresh(languages, seed)
    network.train(np.concatenate(rows), np.array(target), EPOCHS, seed)
    return network


def identify(
    docs: DataFrame, network: Network | None, kept: tuple[str | Column, ...] = ("doc_id",), with_text: bool = False
) -> DataFrame:
    """The columns ``kept`` (not named text), lang_pred and score of every row of ``docs``,
    and the text after them ``with_text``, which then passes the workers once."""
    rows = docs.select(*kept, F.col("text").cast("string").alias("text"))
    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double")
    names = schema.names[:-2]
    if with_text:
        schema = schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied = Applied(network) if network else None
        for batch in sliced(batches, 256):
            texts = batch.column(len(names)).to_pylist()
            known = [i for i, text in enumerate(texts) if applied and text and any(map(str.isalpha, text))]
            labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                found, score = applied.predict([texts[i].encode() for i in known])
                for i, language, probability in zip(known, found, score, strict=True):
                    labels[i], scores[i] = applied.network.languages[language], float(probability)
            made = [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *made, *batch.columns[-1:] * with_text], schema.names
            )

    return rows.mapInArrow(run, schema)


#: A document is undecided, and not accepted, below so many times the even share of a language.
UNDECIDED = 1.1


def accepted(docs: DataFrame, network: Network | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the network can tell.

    Rejected are documents without a letter, and those whose likeliest language has hardly
    more than an even share of the probability. Without a network, that is without any
    labelled document to learn from, nothing is known of any row, and all stay.
    """
    if network is None:
        return docs
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("_row")
    named = identify(docs.select(others, "text"), network, ("_row",), with_text=True)
    sure = F.col("score") >= UNDECIDED / max(len(network.languages), UNDECIDED)
    columns = [F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return named.where((F.col("lang_pred") != UNKNOWN) & sure).select(*columns)
