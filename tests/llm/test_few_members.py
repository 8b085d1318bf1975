"""Rounds of draws leave out shingles of few documents."""

import random

from test_llm_cases import brute_components

from feedloom.llm import jaccard_join
from feedloom.llm.common import stored


def test_rounds_of_draws_only_have_shingles_of_many_documents(spark, monkeypatch):
    draw, rows = random.Random(5), []
    passage = [f"p{i}" for i in range(24)]
    for i in range(90):  # near copies on both sides of the threshold
        words = passage + [f"c{k}" for k in range(60)]
        for _ in range(draw.randrange(9)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(words)))
    for i in range(90, 190):  # pairs
        rows.append((i, " ".join([f"d{i // 2}-{k}" for k in range(60)] + [f"e{i}"])))
    kept = []

    def store(frame, label, **options):
        kept.append((label, made := stored(frame, label, **options)))
        return made

    monkeypatch.setattr(jaccard_join, "stored", store)
    monkeypatch.setattr(jaccard_join, "FEW_PAIRS", 0)
    monkeypatch.setattr(jaccard_join, "STEP", 8)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.groups(frame).collect()}
    assert found == brute_components(rows)
    first, *rounds, last = [made for label, made in kept if label == "jaccard-members"]
    assert rounds and last.count() == first.count()  # in the end, all come
    for made in rounds:
        assert made.groupBy("token").count().where("count < 4").isEmpty()
    assert sum(made.count() for made in rounds) < len(rounds) * first.count()
