"""Terms with a wrong first letter, and masked ones."""

import random

import pytest

from feedloom.llm import toxicity

LEXICON = [("idiot", False, 3.0), ("asshole", False, 3.0), ("scum", False, 3.0), ("moronic", True, 2.0)]


@pytest.mark.parametrize(("text", "term"), [
    ("jdiot", 0), ("1diot", 0), ("diot", 0), ("xidiot", 0), ("*diot", 0), ("id**t", 0), ("@sshole", 1), ("a$$hole", 1),
    ("scvm", 2), ("sc*m", 2), ("*cum", 2), ("scu*", 2), ("noronically", 3), ("oronic", 3),
])
def test_wrong_first_and_masked_letters(text, term):
    words = toxicity._Words(toxicity.Automaton(LEXICON))
    assert [words[token] for token in toxicity.TOKEN.findall(text)] == [(1, term)]


def test_signs_around_words_and_other_words():
    words = toxicity._Words(toxicity.Automaton(LEXICON))
    assert [words[t] for t in toxicity.TOKEN.findall("**idiot** *scum* @idiot")] == [(0, 0), (0, 2), (0, 0)]
    assert not any(words[t] for t in toxicity.TOKEN.findall("scam * ** **** $100 5000 i***t**** the rabbit"))


def distance(one, other):
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(other, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def test_automaton_by_brute_force():
    draw = random.Random(3)
    make = lambda k: "".join(draw.choices("abcd", k=k))
    lexicon = [(t, draw.random() < 0.3, 1.0) for t in dict.fromkeys(make(draw.randrange(3, 11)) for _ in range(25))]
    automaton = toxicity.Automaton(lexicon)
    for word in [make(draw.randrange(2, 12)) for _ in range(1500)]:
        near = []
        for i, (term, stem, _) in enumerate(lexicon):
            starts = [word[:k] for k in range(len(word) + 1)] if stem else [word]
            near.append((min(distance(start, term) for start in starts), i))
        expected = min((n for n in near if n[0] <= toxicity.allowed_edits(lexicon[n[1]][0])), default=None)
        assert automaton.match(word) == expected, word


def test_forgotten_states_change_nothing(monkeypatch):
    words = ["idiot", "1diot", "ideot", "sc*m", "moronical", "harmless", "asshole", "ashole"]
    whole = [toxicity.Automaton(LEXICON).match(word) for word in words]
    monkeypatch.setattr(toxicity, "HELD_STATES", 3)
    small = toxicity.Automaton(LEXICON)
    assert [small.match(word) for word in words * 3] == whole * 3
    assert toxicity.words_of(LEXICON) is toxicity.words_of(list(LEXICON))
    assert toxicity.words_of(LEXICON[:1])["scum"] is None and toxicity.words_of(LEXICON)["scum"]
