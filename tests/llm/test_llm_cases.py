"""Every operator on nulls, empty and long texts, ties, repeats, clashing names, no rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from feedloom.llm import (
    byte_bpe, exact_dedup, fingerprints, jaccard_join, langid, licenses, mixing, pii, toxicity,
)

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def test_bpe(docs, none):
    ranks = {token: i for i, token in enumerate(byte_bpe.byte_table(PATH)) if token}
    model = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoded = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect())
    assert found == Counter((i, tuple(model.encode_ordinary(t))) for i, t in texts_of(docs))
    decoded = byte_bpe.decode(encoded, PATH)
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in decoded.collect()) == Counter(
        (i, t.encode()) for i, t in texts_of(docs)
    )
    assert byte_bpe.decode(byte_bpe.encode(none, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_bpe_offsets_cover_the_text(docs):
    table = byte_bpe.byte_table(PATH)
    texts = dict(texts_of(docs))
    for row in byte_bpe.encode(docs.where("doc_id = 8"), PATH, public_tokenizers.PATTERN).collect():
        text = texts[row["doc_id"]]
        for i, start, end in zip(row["ids"], row["starts"], row["ends"], strict=True):
            assert table[i] in text[start:end].encode()
        assert row["n_split"] > 0 and row["ends"][-1] == len(text)


def test_bpe_broken_characters_are_replaced(spark):
    rows = spark.createDataFrame([(1, "a\U0001f98a\u00e9b"), (2, "")], "doc_id long, text string")
    encoded = byte_bpe.encode(rows, PATH, public_tokenizers.PATTERN)
    whole = {r["doc_id"]: r["text"] for r in byte_bpe.decode_text(encoded, PATH).collect()}
    assert whole == {1: "a\U0001f98a\u00e9b", 2: ""}
    parts = encoded.where("doc_id = 1").selectExpr(
        "doc_id", "explode(sequence(0, size(ids))) as n", "ids as given").selectExpr("n as doc_id", "slice(given, 1, n) as ids")
    for r in byte_bpe.decode_text(parts, PATH).collect():
        assert r["text"] == bytes(r["decoded"]).decode("utf-8", "replace")
        assert "\ufffd" in r["text"] or r["text"] == whole[1][: len(r["text"])]


def test_exact_dedup(docs, none):
    groups = {}
    for doc_id, text in texts_of(docs):
        groups.setdefault(text, []).append(doc_id)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected.update((i, keep, len(ids), i == keep, sha(text)) for i in ids)
    one_bucket = dict(bucket_bytes=1 << 40)
    tiny_buckets = dict(bucket_bytes=1)
    clashing = dict(hashed=lambda c: F.length(c).cast("long"))
    for options in ({}, one_bucket, tiny_buckets, clashing):
        found = exact_dedup.exact_duplicates(docs, **options).collect()
        assert Counter(map(tuple, found)) == expected, options
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_duplicates(none).count() == 0 and exact_dedup.survivors(none).count() == 0


def directory_by_brute_force(sizes, limit):
    """The bucket of each hash, as first bits: split at every bit until it fits."""
    parts = {}

    def split(first, held):
        if sum(size for _, size in held) <= limit or len(held) == 1 or len(first) == exact_dedup.HASH_BITS:
            parts.update((h, first) for h, _ in held)
            return
        for bit in "01":
            some = [(h, size) for h, size in held if f"{h % (1 << 64):064b}"[len(first)] == bit]
            if some:
                split(first + bit, some)

    split("", sizes)
    return parts


def test_directory_doubles_and_splits(spark):
    flat = [(h << 61, 10) for h in (-4, -3, 0, 1, 2)]
    deep = [(h, 10) for h in range(6)] + [(7 << 20, 10), (-1, 500), (1 << 62, 5)]
    for rows in (flat, deep):
        depth, directory = exact_dedup.build_directory(spark.createDataFrame(rows, "h long, bytes long"), 20)
        buckets = {r["slot"]: r["bucket"] for r in directory.collect()}
        expected = directory_by_brute_force(rows, 20)
        for h, _ in rows:
            first = expected[h]
            assert buckets[(h % (1 << 64)) >> (64 - depth)] == int(first.ljust(depth, "0") or "0", 2), (h, first)
    assert depth > 16
    depth, directory = exact_dedup.build_directory(spark.createDataFrame([], "h long, bytes long"))
    assert depth == 0 and directory.count() == 0


def test_licenses(docs, none):
    found = {}
    for row in licenses.summarise(licenses.detect(docs)).collect():
        found.setdefault(row["doc_id"], []).append(row)
    assert found[1][0]["base_labels"] == "mit" and found[1][0]["first_word"] == 1
    assert len(found[2]) == 2 and found[2][0] == found[2][1]
    assert found[5][0]["n_words"] == 0 and found[5][0]["labels"] == "" and found[5][0]["score"] == 0
    assert found[5][0]["first_word"] is None
    assert licenses.summarise(licenses.detect(none)).count() == 0


def test_license_rules():
    assert len(licenses.rules()) > 300
    for rule in licenses.rules():
        assert all(len(key) > 2 for key in rule.keywords), rule
    words = b" released under the terms of the gnu general public license version 3 cc by sa 4 0 "
    places, found = licenses.scan(words)
    assert [label for _, label in places] == ["gpl", "cc-by"]
    assert {d[2] for d in found} == {"gpl", "gpl-3.0", "cc-by-sa-4.0"}
    # A notice that holds a shorter detection suppresses it.
    assert licenses._accept([(0, -9, 0, "a", 9, 1.0), (1, -3, 2, "b", 5, 1.0), (1, -9, 3, "c", 12, 1.0)]) == [
        (0, 9, "a", 1.0), (3, 12, "c", 1.0)
    ]


def test_toxicity(spark, docs, none):
    bad = [(100 + i, f"well you are an {'idiot' if i % 2 else 'utter scumbag'} number {i}") for i in range(40)]
    good = [(200 + i, f"well you are an honest text number {i}") for i in range(80)]
    train = spark.createDataFrame(bad + good, "doc_id long, text string")
    labels = train.select("doc_id", (F.col("doc_id") < 200).cast("int").alias("toxic")).unionByName(
        spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    )
    model = toxicity.learn(train, labels)
    new = spark.createDataFrame(
        [(1, "well you are an idjot number"), (2, "an honest text"), (3, None), (4, "")], "doc_id long, text string"
    )
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(new, model).collect()}
    assert scores[1] > 0.5 > scores[2] and scores[3] == scores[4] < 0.5
    assert toxicity.score(docs, model).count() == docs.count()
    assert toxicity.score(none, model).count() == 0
    assert toxicity.learn(train, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_terms_by_brute_force(spark):
    import math
    import random

    draw = random.Random(6)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(i, " ".join(draw.sample(words[: 26 if i % 4 else 20], 9) + (["zzq"] if i % 9 == 4 else []))) for i in range(400)]
    frame = spark.createDataFrame([(i, t, int(i % 4 == 0)) for i, t in rows], "id int, text string, toxic int")
    total = Counter(r["toxic"] for r in frame.collect())
    counts = frame.select("text", "toxic").mapInArrow(
        toxicity._count_terms, "term string, stem boolean, toxic int, n long").groupBy("term", "stem").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("a"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("b"))
    found = counts.withColumn("g", toxicity.significance(F.col("a"), total[1], F.col("b"), total[0])).collect()
    for r in found:
        texts = [[r["term"] in re.split(r"\W+", t) for i, t in rows if (i % 4 == 0) == toxic] for toxic in (True, False)]
        a, b = map(sum, texts)
        assert (a, b) == (r["a"], r["b"])
        g = 0.0
        for seen, n in ((a, total[1]), (b, total[0])):
            p = (a + b) / (total[0] + total[1])
            g += sum(2 * x * math.log(x / (q * n)) for x, q in ((seen, p), (n - seen, 1 - p)) if x)
        assert abs(g - r["g"]) < 1e-9
    # Many terms: a stem and what it covers, and none left out for being one too many.
    many = [(f"{i:05d}", False, 3.0, 9) for i in range(5000)]
    assert len(toxicity.choose_terms(many)) == 5000
    assert toxicity.choose_terms([("badword", False, 3.0, 9), ("badw", True, 3.0, 9)]) == [("badword", False, 3.0)]
    assert toxicity.choose_terms([("badword", False, 3.0, 9), ("badw", True, 3.0, 30)]) == [
        ("badw", True, 3.0)]


def test_quotation_counts_apart():
    words = toxicity._Words(toxicity.Automaton([("idiot", False, 3.0)]))
    plain = toxicity.features("such an idiot", words)
    quoted = toxicity.features('the author wrote "such an idiot" here', words)
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0


def test_language(spark, docs, none):
    words = {"en": "the thing and that other thing with", "fr": "les choses été déjà où très où"}
    rows = [(i, f"{words[lang]} {i} " * 5, lang) for i in range(60) for lang in words]
    network = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs, network).collect()}
    assert {(i, p) for i, p, s in found if s == 0} == {(None, "und"), (5, "und"), (6, "und"), (7, "und")}
    test = spark.createDataFrame([(1, words["en"] + " now"), (2, words["fr"] + " là")], "doc_id long, text string")
    assert {(r["doc_id"], r["lang_pred"]) for r in langid.identify(test, network).collect()} == {(1, "en"), (2, "fr")}
    assert langid.learn(none) is None and langid.identify(none, network).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_applied_network_is_the_trained_one():
    network = langid.Network.fresh(["a", "b"], 3)
    rows, _ = langid.windows_of("Où 12, straße!".encode() * 40)
    applied = langid.Applied(network).pooled(rows)
    assert abs(applied - network.responses(rows)[0]).max() < 1e-5


def test_fingerprints(docs, none):
    ordered = sorted(texts_of(docs), key=lambda d: (d[0] is None, -(d[0] or 0), d[1]))
    expected = Counter()
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        expected[doc_id, len(text), sha(text[: len(text) - half] + following[:half])] += 1
    for ranges in (1, 3, 50):
        found = fingerprints.edited(docs, ranges).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected
        # Likeness and positions, by sets.
        near = Counter()
        for r in found:
            places = fingerprints.places_of(r["steps"])
            assert len(places) * 8 == len(r["fingerprint"])
            near[r["doc_id"], r["near_edited"], r["near_next"], tuple(places.tolist())] += 1

        def like(a, b):
            a, b = (set(fingerprints.winnow(t)[0].tolist()) for t in (a, b))
            return len(a & b) / len(a | b) if a | b else 1.0

        assert near == Counter(
            (i, like(t, t[: len(t) - len(t) // 2] + u[: len(t) // 2]), like(t, u), tuple(fingerprints.winnow(t)[1].tolist()))
            for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1], strict=True)
        )
    assert fingerprints.places_of(fingerprints.steps_of(np.array([3, 40, 57]), 40), 40).tolist() == [3, 40, 57]
    assert fingerprints.steps_of(np.array([], np.int64)) == "" and fingerprints.places_of("").tolist() == []
    prints = fingerprints.fingerprint(docs)
    assert prints.where("size(hashes) <> size(positions)").count() == 0
    assert fingerprints.edited(none).count() == 0 and fingerprints.fingerprint(none).count() == 0


def test_winnowing_by_brute_force():
    for text in ("", "a", "abab" * 9, "abcabdabe" * 5, "zzzzzzzzzzzzzzz"):
        for gram, window in ((1, 1), (3, 4), (5, 9)):
            points = [ord(c) for c in text]
            size = min(gram, len(text))
            hashes = [
                int(fingerprints.gram_hashes(np.array(points[i : i + size], np.uint32), size)[0])
                for i in range(len(text) - size + 1)
            ] if text else []
            kept = sorted({
                max(j for j in range(i, min(i + window, len(hashes))) if hashes[j] == min(hashes[i : i + window]))
                for i in range(max(1, len(hashes) - window + 1))
            }) if hashes else []
            found, places = fingerprints.winnow(text, gram, window)
            assert places.tolist() == kept and found.tolist() == [hashes[i] for i in kept]


def test_personal_data(spark, docs, none):
    found = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in pii.find_spans(docs).collect()}
    assert found[1] == found[2] == [(22, 0, 37)] and found[5] == found[6] == []
    rows = [(i, f"call Zorblax {i} at a@b.com today {i}") for i in range(5)] + [
        (10 + i, "call me at noon today") for i in range(95)
    ]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find_spans(texts).collect()}
    assert spans[0] == [(5, 4, 12), (18, 0, 25)] and spans[10] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(texts).collect()}
    assert clean[0] == "call [NAME] 0 at [EMAIL] today 0" and clean[10] == "call me at noon today"
    assert pii.find_spans(none).count() == 0 and pii.sanitise(docs).count() == docs.count()


def spans_of(spark, rows):
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find_spans(texts).collect()}


def test_terms_of_entities_that_occur_once_or_twice(spark):
    once, twice = "call Zorblax at a@b.com today", "call Quimby at c@d.com today"
    spans = spans_of(spark, [(0, once), (1, twice), (2, twice + " again")] + [
        (10 + i, "call me again at noon today") for i in range(97)
    ])
    assert spans[0] == [(5, 4, 12), (16, 0, 23)] and spans[10] == []
    assert spans[1] == spans[2] == [(5, 4, 11), (15, 0, 22)]


def test_terms_are_marked_in_whole_texts_and_in_other_documents(spark):
    far = "call Zorblax at a@b.com " + "one two three " * 5 + "then Quimby and zorblax"
    spans = spans_of(spark, [(i, far) for i in (0, 1, 2, 3, 200, 201, 202, 203)] + [
        (5, "here Quimby is alone"), (6, "then Meeks, w@x.com"), (7, "here Meeks is alone"),
        (8, "Quimby and call q@x.com"),
    ] + [
        (10 + i, "call here then one two three alone and today") for i in range(88)
    ])
    assert spans[0] == spans[3] == [(5, 4, 12), (16, 0, 23)] + [
        (far.index(w), 4, far.index(w) + len(w)) for w in ("Quimby", "zorblax")
    ]
    assert spans[5] == [(5, 4, 11)] and spans[8] == [(0, 4, 6), (16, 0, 23)]
    # One meeting may be chance: the word is marked beside an entity only.
    assert spans[6] == [(5, 4, 10), (12, 0, 19)] and spans[7] == [] and spans[10] == []


def test_names_beside_addresses_are_found_and_chance_is_not(spark):
    """2,000 texts of words by a power law, 100 with a name and an address of their own; every
    fourth name is also in a text without the address."""
    import random

    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(draw.choices(letters, k=6)) for _ in range(6000)]
    rows, names = [], {}
    for i in range(2000):
        text = [words[int(6000 * draw.random() ** 3)] for _ in range(60)]
        if i < 100:
            names[i] = "N" + "".join(draw.choices(letters, k=9))
            text[20:20] = [names[i], f"mail{i}@example.org"]
        elif i < 125:
            text[30:30] = [names[(i - 100) * 4]]
        rows.append((i, " ".join(text)))
    spans = spans_of(spark, rows)
    texts = dict(rows)
    found = [i for i, name in names.items() if any(texts[i][a:b] == name for a, kind, b in spans[i] if kind == 4)]
    assert len(found) >= 90
    assert sum(bool(spans[i]) for i in range(100, 2000)) <= 0.02 * 1900


def test_wilson_bound(spark):
    rows = [(1.0, 1.0), (1.0, 2.0), (2.0, 3.0), (40.0, 50.0), (0.0, 5.0)]
    found = spark.createDataFrame(rows, "k double, n double").select("k", "n", pii.surely(F.col("k"), F.col("n")).alias("b"))
    for k, n, bound in found.collect():
        # The bound solves (k/n - b) = z * sqrt(b (1 - b) / n).
        assert abs((k / n - bound) - pii.QUANTILE * (max(0, bound * (1 - bound)) / n) ** 0.5) < 1e-9


def test_documents_of_only_an_address_count_for_its_entity(spark):
    spans = spans_of(spark, [(i, "see Zorblax now, a@b.com" if i < 3 else "see Zorblax now") for i in range(6)] + [
        (10 + i, "a@b.com") for i in range(20)
    ] + [(40 + i, "see now") for i in range(74)])
    assert spans[0] == [(17, 0, 24)] and spans[5] == [] and spans[10] == [(0, 0, 7)]


def test_spans_by_brute_force(spark, monkeypatch):
    import random
    from math import log2

    monkeypatch.setattr(pii, "FREQUENT", 0.02)  # both ways: of frequent and of other ones
    draw = random.Random(5)
    names = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(400)]
    rows = []
    for i in range(400):
        words = [names[int(400 * draw.random() ** 2)] for _ in range(12)]
        if i % 3 == 0:
            words.insert(draw.randrange(12), f"u{draw.randrange(9)}@{names[0]}.com")
            words.insert(0, f"+49 30 {1000000 + i // 9}")
        if any(w.startswith("u0@") for w in words) or i in (1, 4, 7):
            words.append("steady")
        rows.append((i, " ".join(words)))
    holds, free, places = {}, {}, {}
    for i, text in rows:
        base = pii.find_base(text)
        holds[i] = {pii._entity(kind, text[a:b]) for a, kind, b in base}
        places[i] = [
            (m.start(), 4, m.end()) for m in pii._WORD.finditer(text)
            if not any(a < m.end() and m.start() < b for a, _, b in base)
        ]
        free[i] = {text[a:b] for a, _, b in places[i]}
    n_e, n_t = Counter(e for x in holds.values() for e in x), Counter(t for x in free.values() for t in x)
    n_et = Counter((e, t) for i in holds for e in holds[i] for t in free[i])
    disclosing = {
        t for (e, t), n in n_et.items()
        if log2(400 / n_e[e] * (n + 0.5 * n_e[e] / 400) / (n_t[t] + 0.5)) >= 0.75 * log2(400 / n_e[e])
    }

    def bound(k, n, z=pii.QUANTILE):
        p = k / n
        return (p + z * z / 2 / n - z * (p * (1 - p) / n + z * z / 4 / n / n) ** 0.5) / (1 + z * z / n)

    outside = {
        t for (e, t), n in n_et.items()
        if t in disclosing and bound(n, n_t[t]) >= 0.25
        and log2(400 / n_e[e] * bound(n, n_t[t])) >= 0.75 * log2(400 / n_e[e])
    }
    assert outside and outside < disclosing and len(disclosing) < len(n_t)
    expected = {
        i: sorted(pii.find_base(t) + [
            p for p in places[i] if t[p[0] : p[2]] in (disclosing if holds[i] else outside)
        ]) for i, t in rows
    }
    assert spans_of(spark, rows) == expected


def test_base_patterns():
    card = "4111 1111 1111 1111"
    assert [k for _, k, _ in pii.find_base(f"x@y.z 1.2.3.4 999.1.1.1 card {card} +49 (30) 1234567")] == [0, 1, 2, 3]
    assert pii.find_base("@a.b x@y 1.2.3 4111 1111 1111 1112 +1 2") == []


def test_mixing(docs, none):
    rows = docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"), "key")
    found = mixing.mixture(rows).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows.collect())
    assert all(r["copies"] in (0, 1, 2) for r in found)
    again = mixing.mixture(rows.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert mixing.mixture(rows.limit(0)).count() == 0 and mixing.mix(none).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert set(map(tuple, mixed.collect())) <= set(map(tuple, docs.collect()))


def test_mix_meets_its_targets(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 > 0, "big").otherwise((F.col("id") % 7).cast("string"))).alias("source"),
        (F.pmod(F.xxhash64("id"), F.lit(300)) + 1).alias("size"),
    )
    taken = mixing.mixture(rows).groupBy("source", "target", "source_size").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken")
    ).collect()
    total = sum(r["source_size"] for r in taken)
    assert abs(sum(r["target"] for r in taken) - 1.5 * total) < 1e-6 * total
    for row in taken:
        assert row["target"] <= 2 * row["source_size"] + 1e-6
        assert abs(row["taken"] - row["target"]) <= 300


def brute_components(rows):
    sets = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((i, {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    parts = {i: i for i, _ in sets}
    for i, one in sets:
        for j, other in sets:
            if i < j and one and 100 * len(one & other) >= 75 * len(one | other) and parts[i] != parts[j]:
                low, high = sorted((parts[i], parts[j]))
                parts = {k: low if v == high else v for k, v in parts.items()}
    return {i: (len(s), parts[i]) for i, s in sets}


def test_jaccard_join_by_brute_force(spark):
    import random

    draw = random.Random(4)
    base = [f"w{draw.randrange(40)}" for _ in range(60)]
    rows = [(0, None), (1, ""), (2, "Only THREE words"), (3, "only three Words"), (4, " \t")]
    for i in range(10, 250):
        words = list(base[draw.randrange(20) :]) if i % 2 else [f"v{draw.randrange(300)}" for _ in range(30)] + base[:30]
        for _ in range(draw.randrange(7)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(30)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.groups(frame).collect()}
    assert found == brute_components(rows)


def test_jaccard_join_cases(docs, none):
    found = jaccard_join.groups(docs)
    assert found.count() == docs.count()
    pairs = Counter((r["doc_id"], r["component_id"]) for r in found.collect())
    assert pairs[2, 1] == 2 and pairs[None, 9] == 1 and pairs[5, 5] == 1 and pairs[None, None] == 1
    kept = jaccard_join.survivors(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert jaccard_join.groups(none).count() == 0 and jaccard_join.survivors(none).count() == 0


def test_draws_of_the_jaccard_join_by_brute_force(spark, monkeypatch):
    import random

    draw = random.Random(8)
    passage = [f"p{i}" for i in range(24)]
    rows = []
    for i in range(260):  # near copies on both sides of the threshold, among texts with one passage
        own = [f"c{k}" for k in range(60)] if i % 3 == 0 else [f"o{i}-{k}" for k in range(40)]
        words = passage + own
        for _ in range(draw.randrange(5)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard_join, "FEW_PAIRS", 0)
    monkeypatch.setattr(jaccard_join, "STEP", 4)
    assert jaccard_join.first_share(260, 10_000, 260) == 64 and jaccard_join.first_share(None, None, None) == 1
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.groups(frame).collect()}
    assert found == brute_components(rows)
