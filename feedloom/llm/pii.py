"""Personal data, and the terms that give it away, by information content.

Mail addresses, IP addresses, card and phone numbers are found by pattern. Each found
value is a protected entity. The words outside entities, in the whole of each text, are
candidates: over the corpus, the pointwise mutual information of word and entity, as a
share of the entity's own information content, says how much of the entity the word
discloses (1: whoever sees the word knows the entity). A word at or above a threshold for
any entity is a span of kind ``term`` wherever it stands outside entities in documents
that have an entity; there is no floor of texts, so that an entity written once is judged
like others. In documents without any entity it is one only if the two did not meet by
chance: the lower bound of P(entity | word), by Wilson's interval of one side at 95 %,
must be OUTSIDE or more, whatever N is, and reach the threshold of the share, too. One
meeting is never enough for a word that is in other texts besides. Sanitising generalises a
name to ``[NAME]``, removes other terms, and puts the kind in the place of an entity.

    share = log2(N / n_e * (n_et + SMOOTH * n_e / N) / (n_t + SMOOTH)) / log2(N / n_e)

with N documents, n_e with the entity, n_t with the term outside entities, n_et with both.

Pairs are left out before they are counted only where ``n_t`` is so large that no ``n_et``
could reach the threshold. Words and entities in more than FREQUENT of all documents are
a bounded number whatever N is, and known to all workers; other disclosing terms are
looked up by a bitmap and then joined, so that the bitmap decides nothing.

Defined cases: a null text is an empty one, without spans; a null doc_id is a value like
others; repeated rows each count as a document and have the same spans; an entity in all
documents has no information and discloses nothing; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, stored, text_of

KINDS = ("email", "ip", "card", "phone", "term")
#: The share of an entity's information from which a term discloses it.
SHARE = 0.75
#: Texts without the entity that every term counts as having been seen in besides.
SMOOTH = 0.5
#: The lower bound of P(entity | term) from which a term is marked where no entity is, and
#: the quantile of the normal distribution for 95 %.
OUTSIDE, QUANTILE = 0.25, 1.6449
#: The share of all documents from which a word or an entity is frequent.
FREQUENT = 0.001
#: Bits of the bitmap for each term, and at most.
BITS, MOST_BITS = 64, 1 << 28
#: Words whose counts a worker holds before it passes them on.
HELD_WORDS = 200_000

# Fixed by the task. No match can begin inside a run of digits or go on after one, which
# the look-behinds say, so that long runs are not tried again from each of their digits.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_LETTER = re.compile(r"[^\W\d_]")
_DIGITS = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def _valid_ip(found: str) -> bool:
    # A part of many digits may still be small: 000001.
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in found.split("."))


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every entity, by start and kind."""
    spans = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _valid_ip(m[0])]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _entity(kind: int, found: str) -> str:
    value = found.lower() if kind == 0 else found if kind == 1 else _DIGITS.sub("", found)
    return f"{KINDS[kind]}:{value}"


def _free_words(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words that no entity reaches into."""
    entities = iter(base)
    end, following = -1, next(entities, None)
    for m in _WORD.finditer(text):
        a, b = m.span()
        while following and following[0] < b:
            end, following = max(end, following[2]), next(entities, None)
        if end <= a:
            yield m[0].lower(), a, b


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
def _places(text: str, word: str) -> Iterator[tuple[int, int]]:
    """Where the word stands as a whole run of letters."""
    start = text.find(word)
    while start >= 0:
        end = start + len(word)
        if not (start and _LETTER.match(text, start - 1)) and not _LETTER.match(text, end):
            yield start, end
        start = text.find(word, end)


_TEXTS = pa.list_(pa.string())
_PLACES = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts = batch["text"].to_pylist()
        base = [find_base(text) for text in texts]
        spans = [[dict(zip(("start", "kind", "end"), s, strict=True)) for s in row] for row in base]
        entities = [
            sorted({_entity(kind, text[start:end]) for start, kind, end in b})
            for text, b in zip(texts, base, strict=True)
        ]
        terms = [
            sorted({term for term, _, _ in _free_words(text, b)}) if b else []
            for text, b in zip(texts, base, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["key"], pa.array(spans, _SPAN), pa.array(entities, _TEXTS), pa.array(terms, _TEXTS)],
            ["doc_id", "key", "base", "entities", "terms"],
        )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each word stands outside entities, in parts that later are added up."""

    def part(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"]
        )

    counts: Counter = Counter()
    for batch in sliced(batches):
        for text in batch["text"].to_pylist():
            base = find_base(text)
            # Words are runs of letters, so those of most texts need no places.
            words = (term for term, _, _ in _free_words(text, base)) if base else map(str.lower, _WORD.findall(text))
            counts.update(set(words))
        if len(counts) > HELD_WORDS:
            yield part(counts)
            counts = Counter()
    yield part(counts)


def _together(found: DataFrame, entities: DataFrame, words: DataFrame, total: int, share: float) -> DataFrame:
    """entity, term, n_et; without pairs that are too common to reach ``share``."""
    frequent = FREQUENT * total
    # With all of a rare entity's documents, a term in more documents than this stays below.
    bound = (frequent + SMOOTH * FREQUENT) / FREQUENT ** (1 - share) - SMOOTH if share > 0 else float("inf")
    often = frozenset(r["entity"] for r in entities.where(F.col("n_e") > frequent).select("entity").collect())
    common = frozenset(r["term"] for r in words.where(F.col("n_t") > bound + 1e-6 * total).select("term").collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: list[str] = []
        with_it: list[str] = []
        for batch in sliced(batches):
            for here, terms in zip(batch["entities"].to_pylist(), batch["terms"].to_pylist(), strict=True):
                rare = [term for term in terms if term not in common]
                for entity in here:
                    seen = terms if entity in often else rare
                    of += [entity] * len(seen)
                    with_it += seen
                    if len(of) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(with_it)], ["entity", "term"])
                        of, with_it = [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(of, pa.string()), pa.array(with_it, pa.string())], ["entity", "term"]
        )

    pairs = found.where("size(entities) > 0").select("entities", "terms").mapInArrow(run, "entity string, term string")
    return pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))


def surely(hits: Column, trials: Column) -> Column:
    """The lower end of Wilson's interval for a share of ``hits`` in ``trials``."""
    z, p = F.lit(QUANTILE), hits / trials
    spread = z * F.sqrt(p * (1 - p) / trials + z * z / (4 * trials * trials))
    return (p + z * z / (2 * trials) - spread) / (1 + z * z / trials)


def _disclosing(found: DataFrame, rows: DataFrame, total: int, share: float) -> DataFrame:
    """term, n_t of every term that discloses some entity; outside: also where no entity is."""
    entities = stored(
        found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")),
        "pii-entities",
    )
    words = stored(
        rows.select("text").mapInArrow(_count_words, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t")),
        "pii-words",
    )
    information = F.log2(F.lit(float(total)) / F.col("n_e"))
    chance = (F.col("n_et") + SMOOTH * F.col("n_e") / F.lit(float(total))) / (F.col("n_t") + SMOOTH)
    mutual = F.log2(F.lit(float(total)) / F.col("n_e") * chance)
    bound = surely(F.col("n_et").cast("double"), F.col("n_t").cast("double"))
    certain = (bound >= OUTSIDE) & (F.log2(F.lit(float(total)) / F.col("n_e") * bound) >= F.lit(share) * information)
    return stored(
        _together(found, entities, words, total, share).join(entities, "entity").join(words, "term")
        .where((information > 0) & (mutual >= F.lit(share) * information))
        .groupBy("term").agg(F.max("n_t").alias("n_t"), F.bool_or(certain).alias("outside")),
        "pii-disclosing",
    )


def _bitmap(terms: DataFrame) -> bytes:
    """A bit for the checksum of each term; a power of two of bits."""
    bits = 1 << 15
    wanted = min(MOST_BITS, BITS * terms.count())
    while bits < wanted:
        bits *= 2
    place = F.pmod(F.crc32("term"), F.lit(bits))
    blocks = terms.select(place.alias("place")).groupBy(F.expr("place div 32768").alias("block")).agg(
        F.expr("bitmap_construct_agg(place % 32768)").alias("bits")
    )
    whole = bytearray(bits // 8)
    for row in blocks.collect():
        whole[row["block"] * 4096 : (row["block"] + 1) * 4096] = row["bits"]
    return bytes(whole)


def _occurrences(rows: DataFrame, disclosing: DataFrame, total: int) -> DataFrame:
    """of, key, places: where disclosing terms stand outside entities; several rows of a text."""
    is_often = F.col("n_t") > FREQUENT * total
    often = {r["term"]: r["outside"] for r in disclosing.where(is_often).select("term", "outside").collect()}
    rare = disclosing.where(~is_often).select("term", "outside")
    near, far = _bitmap(rare), _bitmap(rare.where("outside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, int]] = {}

        def look(term: str) -> tuple[int, int]:
            """In texts with an entity and in others, 2: discloses; 1: may disclose; 0: does not."""
            if len(known) >= HELD_WORDS:
                known.clear()
            code = zlib.crc32(term.encode("utf-8", "surrogatepass"))
            may = [bits[at >> 3] >> (at & 7) & 1 for bits in (near, far) for at in [code & 8 * len(bits) - 1]]
            if term in often:
                may = [2, 2 if often[term] else 0]
            known[term] = found = (may[0], may[1])
            return found

        for batch in sliced(batches):
            out: list[tuple] = []
            for of, key, text in zip(*(batch[c].to_pylist() for c in ("of", "key", "text")), strict=True):
                hits = {}
                for word in set(_WORD.findall(text)):
                    term = word.lower()
                    state = known.get(term) or look(term)
                    if state[0]:
                        hits[word] = state
                if not hits:
                    continue
                sure, may, base = [], {}, find_base(text)
                if base:
                    states = {word.lower(): state[0] for word, state in hits.items()}
                    places = ((t, a, b) for t, a, b in _free_words(text, base) if t in states)
                else:
                    states = {word: state[1] for word, state in hits.items() if state[1]}
                    places = ((word, a, b) for word in states for a, b in _places(text, word))
                for word, start, end in places:
                    (sure if states[word] == 2 else may.setdefault(word.lower(), [])).append(
                        {"start": start, "kind": 4, "end": end}
                    )
                own = bool(base)
                out += [(of, key, None, own, sure)] * bool(sure)
                out += [(of, key, term, own, at) for term, at in may.items()]
            if out:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), _PLACES)
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["of", "key", "term", "own", "places"])

    seen = stored(
        rows.select("of", "key", "text").mapInArrow(
            run,
            "of string, key long, term string, own boolean, places array<struct<start:int,kind:int,end:int>>",
        ),
        "pii-seen",
    )
    sure = seen.where("term is null").select("of", "key", "places")
    rest = seen.where("term is not null").join(rare, "term").where("own or outside")
    return sure.unionByName(rest.select("of", "key", "places"))


def find_spans(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, key, spans (start, kind, end) of every row; key is a hash of the text.

    ``kind`` is a place in KINDS; spans are ordered by start, kind, end.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).select(
        "*", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"), F.xxhash64("text").alias("key")
    )
    found = stored(
        rows.select("doc_id", "key", "text").mapInArrow(
            _find,
            "doc_id long, key long, base array<struct<start:int,kind:int,end:int>>,"
            "entities array<string>, terms array<string>",
        ),
        "pii-found",
    )
    total = max(1, found.count())
    marks = (
        _occurrences(rows, _disclosing(found, rows, total, share), total)
        .groupBy(F.col("of"), F.col("key").alias("of_key"))
        .agg(F.flatten(F.collect_set("places")).alias("marks"))
    )
    return found.join(
        marks,
        (F.coalesce(F.col("doc_id").cast("string"), F.lit("")) == F.col("of")) & (F.col("key") == F.col("of_key")),
        "left",
    ).select(
        "doc_id", "key", "base",
        F.sort_array(F.concat("base", F.coalesce("marks", F.expr("array()").cast(
            "array<struct<start:int,kind:int,end:int>>"
        )))).alias("spans"),
    )


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """doc_id, text of every row, with entities and disclosing terms taken out."""
    spans = find_spans(docs, **thresholds)
    once = spans.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"), "key", "spans"
    ).dropDuplicates(["of", "key"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).select(
        "*", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"), F.xxhash64("text").alias("key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            clean = [
                _replaced(text, [(s["start"], s["kind"], s["end"]) for s in spans])
                for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(clean, pa.string())], ["doc_id", "text"])

    return rows.join(once, ["of", "key"]).select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, text string"
    )


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start < at:
            at = max(at, end)  # overlaps what is gone already
            continue
        found = text[start:end]
        general = "[NAME]" if found[:1].isupper() else ""
        out += [text[at:start], general if kind == 4 else f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def as_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )), ",")
