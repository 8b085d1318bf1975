"""Toxicity: a learnt lexicon, matched with misspellings, weighed by context.

The lexicon (whole words, and stems that any ending may follow) is learnt from labelled
documents: terms that are in toxic ones far more often than in others, with the log of that ratio as weight. It is kept as a
trie. Matching intersects the trie with the Levenshtein automaton of a word: a state is a
set of (trie node, edits so far), made when first met and kept, so a word costs one step
per letter and most words leave the trie after a few. It starts at the root, so the first
letter may be wrong, missing or one too many. Letters of terms of any length may be masked
(``*``) or written as something that looks alike; such a hit counts as misspelled, and
at least half of the word must be letters. Signs around a word may belong to it (``@ss``)
or not (``*ass*``): the nearest reading counts.

Each hit is looked at in a window of words: inside quotation marks or beside words of
reporting it counts as quoted, beside words of address as aimed at somebody. Counts of
these go to a logistic regression, trained on the same labelled documents.

The labelled sample is bounded: about SAMPLE documents of either label, chosen by hash of
their ids. All terms of it that are significant are learnt, so the lexicon is bounded by
the words of that sample. Scoring reads every text whole.

Defined cases: a null or empty text has no hits and gets the score of a text without
hits; without labels of both kinds there is no lexicon and all scores are 0; a null
doc_id hashes as an empty text and has no label; of several labels of one document the
largest counts; repeated rows have equal scores; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, text_of

#: The bound of what is learnt from: documents of either label (on average).
SAMPLE = 10_000
#: A term must be this many times as frequent in toxic documents as elsewhere, and not by
#: chance: the likelihood ratio statistic must be so much (8 in a million by chance).
RATIO, SIGNIFICANT = 8.0, 20.0
STEMS = range(4, 9)
#: Weights that differ by less count as equal.
CLOSE = 0.7
WINDOW = 6
CACHED_WORDS = 400_000
#: States an automaton keeps; with more it begins anew.
HELD_STATES = 100_000

TOKEN = re.compile(r"(?:[*@$]+(?=[^\W_]))?[^\W_](?:[^\W_]|(?:[*@$]+|[!'])(?=[^\W_]))*\**|[\"“”„«»]")
#: Signs that can be a part of a word or stand around it.
SIGNS = "*@$"
#: What a sign, digit or letter may stand for; ``*`` for anything.
ALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "v": "u"}
QUOTES = frozenset("\"“”„«»")
REPORTING = frozenset(
    "said says wrote writes called quote quoted quotes word words term terms "
    "sagte schrieb nannte zitat wort dit écrit appelé mot dijo escribió llamó palabra".split()
)
ADDRESS = frozenset("you your yours you're u ya du dich dein ihr tu toi vous votre tú eres usted".split())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Words to the nearest term of a lexicon: (term, edits), or None.

    ``lexicon``: (term, stem, weight); a stem matches words that begin like it. Of terms
    that are equally near, the first of the lexicon is found.
    """

    def __init__(self, lexicon: list[tuple[str, bool, float]]):
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]
        for i, (term, _, _) in enumerate(lexicon):
            node = 0
            for char in term:
                self.most[node] = max(self.most[node], allowed_edits(term))
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.children[node][char]
            self.most[node] = max(self.most[node], allowed_edits(term))
            self.ends[node].append(i)
        self._forget()

    def _forget(self) -> None:
        # A state is its items: edits by node, and the best stem already read.
        self.known: dict[frozenset, int] = {}
        self.items: list[tuple[dict[int, int], tuple[int, int] | None]] = []
        self.steps: list[dict[str, int]] = []
        self.accepted: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0}, None)

    def _best(self, nodes: dict[int, int], stems: bool) -> tuple[int, int] | None:
        """(edits, term) of the best term that ends in one of the nodes."""
        return min((
            (edits, i) for node, edits in nodes.items() for i in self.ends[node]
            if edits <= allowed_edits(self.lexicon[i][0]) and (not stems or self.lexicon[i][1])
        ), default=None)

    def _state(self, nodes: dict[int, int], stem: tuple[int, int] | None) -> int:
        """The state of these nodes and all that skipping letters of a term adds; -1: none."""
        queue = list(nodes.items())
        while queue:
            node, edits = queue.pop()
            if edits < self.most[node] and nodes.get(node) == edits:
                for child in self.children[node].values():
                    if edits + 1 <= self.most[child] and edits + 1 < nodes.get(child, 99):
                        nodes[child] = edits + 1
                        queue.append((child, edits + 1))
        stem = min(filter(None, (stem, self._best(nodes, True))), default=None)
        if not nodes and stem is None:
            return -1
        key = frozenset([*nodes.items(), ("stem", stem)])
        if key not in self.known:
            self.known[key] = len(self.items)
            self.items.append((nodes, stem))
            self.steps.append({})
            self.accepted.append(min(filter(None, (stem, self._best(nodes, False))), default=None))
        return self.known[key]

    def _step(self, state: int, char: str) -> int:
        nodes, stem = self.items[state]
        after: dict[int, int] = {}
        for node, edits in nodes.items():
            meant = self.children[node] if char == "*" else char + ALIKE.get(char, "")
            for child in filter(None, map(self.children[node].get, meant)):
                if edits <= self.most[child]:
                    after[child] = min(edits, after.get(child, 99))
            if edits < self.most[node]:
                after[node] = min(edits + 1, after.get(node, 99))  # one letter too many
                for other in self.children[node].values():  # another letter
                    if edits + 1 <= self.most[other]:
                        after[other] = min(edits + 1, after.get(other, 99))
        self.steps[state][char] = to = self._state(after, stem)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, place in the lexicon) of the nearest term."""
        if 2 * sum(map(str.isalpha, word)) < len(word):
            return None
        if len(self.items) > HELD_STATES:
            self._forget()
        state = self.start
        for char in word:
            if state < 0:
                return None
            to = self.steps[state].get(char)
            state = self._step(state, char) if to is None else to
        found = self.accepted[state] if state >= 0 else None
        if found and not found[0] and not word.startswith(self.lexicon[found[1]][0]):
            return 1, found[1]  # masked letters are no edits, but not the term itself
        return found


class _Words(dict):
    """Matches of words, looked up once; all are forgotten when there are too many."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str):
        if len(self) >= CACHED_WORDS:
            self.clear()
        read = {word, word.lstrip(SIGNS), word.rstrip(SIGNS), word.strip(SIGNS)}
        self[word] = found = min(filter(None, map(self.automaton.match, read)), default=None)
        return found


_HELD: dict[tuple, _Words] = {}


def words_of(lexicon: list[tuple[str, bool, float]]) -> _Words:
    """Matches by a lexicon; a worker keeps those of its last one for the tasks to come."""
    key = tuple(lexicon)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = _Words(Automaton(lexicon))
    return _HELD[key]


FEATURES = ("exact", "fuzzy", "quoted", "aimed", "terms", "density", "heaviest")


def features(text: str, words: _Words) -> list[float]:
    """Weights of hits by their context and counts, on a log scale, weight per hundred words,
    and the heaviest hit."""
    tokens = TOKEN.findall(text.lower())
    hits = [(i, hit) for i, hit in enumerate(map(words.__getitem__, tokens)) if hit]
    tokens = [token.strip(SIGNS) for token in tokens]
    exact = fuzzy = quoted = aimed = heaviest = 0.0
    open_quote = {}
    if hits:
        inside = False
        for i, token in enumerate(tokens):
            if token in QUOTES:
                inside = not inside
            elif inside:
                open_quote[i] = True
    for i, (edits, term) in hits:
        weight = words.automaton.lexicon[term][2]
        around = tokens[max(0, i - WINDOW) : i + WINDOW + 1]
        if i in open_quote and QUOTES.intersection(tokens[i + 1 : i + 30]) or REPORTING.intersection(around):
            quoted += weight
            continue
        heaviest = max(heaviest, weight / (1 + edits))
        if edits:
            fuzzy += weight
        else:
            exact += weight
        aimed += bool(ADDRESS.intersection(around))
    different = len({term for _, (_, term) in hits})
    return [
        *np.log1p([exact, fuzzy, quoted, aimed, different]).tolist(),
        min(30.0, 100 * (exact + fuzzy) / max(20, len(tokens))),
        heaviest,
    ]


@dataclass
class Model:
    lexicon: list[tuple[str, bool, float]]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-((rows - self.centre) / self.scale @ self.weights + self.offset)))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, stem, toxic, n): in how many texts a word or stem is, in parts."""

    def part(counts: Counter) -> pa.RecordBatch:
        terms, stems, toxic = zip(*counts, strict=True) if counts else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(stems, pa.bool_()), pa.array(toxic, pa.int32()), pa.array(counts.values(), pa.int64())],
            ["term", "stem", "toxic", "n"],
        )

    counts: Counter = Counter()
    for batch in sliced(batches):
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            words = {w for w in (t.strip(SIGNS) for t in TOKEN.findall(text.lower())) if len(w) >= 3}
            counts.update((word, False, toxic) for word in words)
            counts.update((stem, True, toxic) for stem in {w[:k] for w in words for k in STEMS if len(w) > k})
        if len(counts) > 300_000:
            yield part(counts)
            counts = Counter()
    yield part(counts)


def choose_terms(rows: list[tuple[str, bool, float, int]]) -> list[tuple[str, bool, float]]:
    """The lexicon, (term, stem, weight), heaviest terms first.

    ``rows``: term, stem, weight (log of the ratio of frequencies), toxic texts with it.
    A term goes without those that a stem covers which weighs about as much; a stem must
    add to the words and longer stems that begin with it.
    """
    chosen: dict[tuple[str, bool], tuple[float, int]] = {}
    begun: dict[str, list[tuple[float, int]]] = {}
    for term, stem, weight, inside in sorted(rows, key=lambda r: (-r[3], r[1], -len(r[0]), r[0])):
        covers = [chosen[term[:k], True][0] for k in STEMS if (term[:k], True) in chosen]
        if covers and max(covers) >= weight - CLOSE:
            continue
        longer = [n for w, n in begun.get(term, ()) if stem and w >= weight - CLOSE]
        if sum(longer) < 0.9 * inside:
            chosen[term, stem] = (weight, inside)
            for k in STEMS:
                if len(term) >= k:
                    begun.setdefault(term[:k], []).append((weight, inside))
    return sorted(((*key, weight) for key, (weight, _) in chosen.items()), key=lambda t: (-t[2], t))


def significance(inside: Column, toxic: int, outside: Column, others: int) -> Column:
    """The likelihood ratio statistic of a term's being in ``inside`` of the ``toxic`` texts
    and in ``outside`` of the others."""
    share = (inside + outside) / float(toxic + others)

    def cell(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (
        cell(inside, share * toxic) + cell(toxic - inside, (1 - share) * toxic)
        + cell(outside, share * others) + cell(others - outside, (1 - share) * others)
    )


def learn(docs: DataFrame, labels: DataFrame, seed: int = 0) -> Model | None:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); every row of
    ``labels`` may be learnt from."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    counts = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chance = F.when(F.col("toxic") == 1, SAMPLE / counts[1]).otherwise(SAMPLE / counts[0])
    # Some 2 * SAMPLE rows of two numbers, whatever the size of the tables.
    sample = F.broadcast(known.where(draw < chance))
    texts = docs.select("doc_id", text_of().alias("text")).join(sample, "doc_id")
    total = {row["toxic"]: row["count"] for row in texts.groupBy("toxic").count().collect()}
    if not total.get(0) or not total.get(1):
        return None
    inside = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))
    outside = F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
    ratio = ((F.col("inside") + 0.5) / (total[1] + 1)) / ((F.col("outside") + 0.5) / (total[0] + 1))
    terms = (
        texts.select("text", "toxic")
        .mapInArrow(_count_terms, "term string, stem boolean, toxic int, n long")
        .groupBy("term", "stem").agg(inside.alias("inside"), outside.alias("outside"))
        .where(ratio >= RATIO)
        .where(significance(F.col("inside"), total[1], F.col("outside"), total[0]) >= SIGNIFICANT)
        .select("term", "stem", F.log(ratio).alias("weight"), "inside")
    )
    lexicon = choose_terms([tuple(row) for row in terms.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(lexicon)
        for batch in sliced(batches):
            found = [features(text, words) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array(found, pa.list_(pa.float64()))], ["toxic", "features"]
            )

    rows = texts.select("toxic", "text").mapInArrow(run, "toxic int, features array<double>").collect()
    prior = counts[1] / (counts[0] + counts[1])
    return _fit(lexicon, np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows]), prior)


def _fit(lexicon, rows: np.ndarray, target: np.ndarray, prior: float) -> Model:
    """Logistic regression by Newton's steps, with a small ridge; labels weigh as in the
    whole of the labels, whatever their shares in the sample."""
    order = np.lexsort([*rows.T, target])  # sums don't depend on how rows arrived
    rows, target = rows[order], target[order]
    centre, scale = rows.mean(0), rows.std(0) + 1e-9
    x = np.column_stack([(rows - centre) / scale, np.ones(len(rows))])
    weight = np.where(target == 1, prior / (target == 1).mean(), (1 - prior) / (target == 0).mean())
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-(x @ beta)))
        slope = x.T @ (weight * (target - p)) - 1.0 * np.append(beta[:-1], 0)
        curve = (x.T * (weight * p * (1 - p))) @ x + np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
        beta = beta + np.linalg.solve(curve, slope)
    return Model(lexicon, centre, scale, beta[:-1], float(beta[-1]))


def score(docs: DataFrame, model: Model | None, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``kept``, and score and predicted, of every row of ``docs``."""
    rows = docs.select(*kept, text_of().alias("_text"))
    schema = rows.drop("_text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(model.lexicon) if model else None
        for batch in sliced(batches):
            texts = batch["_text"].to_pylist()
            scores = model.score(np.array([features(t, words) for t in texts])) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                [*kept, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)
