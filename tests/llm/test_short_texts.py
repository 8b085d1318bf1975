"""Fingerprints of texts of a sentence or less."""

import random

from feedloom.llm import fingerprints


def test_passages_of_15_code_points_share_a_fingerprint():
    draw = random.Random(1)
    some = lambda n: "".join(draw.choices("abcdefghijklmnop ", k=n))
    for _ in range(300):
        passage = some(15)
        one, other = (set(fingerprints.winnow(some(draw.randrange(90)) + passage + some(30))[0].tolist()) for _ in "ab")
        assert one & other


def test_short_texts_are_nearer_to_their_edited_form_than_to_the_next(spark):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randrange(3, 9))) for _ in range(500)]
    rows = [(i, " ".join(draw.choices(words, k=50))[: draw.randrange(40, 100)]) for i in range(300)]
    found = fingerprints.edited(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert len(found) == 300
    assert all(r["near_edited"] > r["near_next"] for r in found)
