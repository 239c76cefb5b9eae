"""The toxicity gate: it lets through whatever a reading may come from, at any length."""

import random

import pytest

from weftline.llm import deobfuscate

ODD = ".-_*~·' ,/²½٣Ⅷ©—$!@|(+014357éß"


@pytest.fixture(scope="module")
def scorer(make):
    rng = random.Random(3)
    vocabulary = ["you", "stupid", "idiot", "table", "green", "house", "walking", "never", "garden", "moron"]
    model = deobfuscate.fit_language_model(deobfuscate.word_counts(make([" ".join(rng.choices(vocabulary, k=50)) for _ in range(50)])))
    return deobfuscate.Scorer(model, deobfuscate.Lexicon({"stupid": 0.9, "idio*": 0.8, "moron": 0.7, "all": 0.6, "w8": 0.5, "il": 0.6}))


def disguised(rng, word, gaps):
    out = []
    for char in word:
        char = rng.choice([char, char, char * rng.randint(1, 3), {"i": "1", "o": "0", "s": "$", "t": "7", "l": "|", "a": "@"}.get(char, char)])
        out += [char, "".join(rng.choices(ODD, k=rng.randint(0, gaps)))]
    return "".join(out)


def tokens(n, gaps):
    rng = random.Random(n)
    for _ in range(n):
        word = rng.choice(["stupid", "idiotic", "moron", "all", "w8", "table", "il", "pidstu", "walking"])
        yield rng.choice(["", "x", "re"]) + disguised(rng, word, gaps) + rng.choice(["", "!!", "s"])


@pytest.mark.parametrize("gaps", [1, 4, 12])
def test_a_closed_gate_means_no_reading(scorer, gaps):
    opened = 0
    for token in tokens(500, gaps):
        opened += scorer.may_hit(token)
        if not scorer.may_hit(token):
            assert not scorer.hits(scorer.restorer.decode(token)), token
    assert 50 < opened < 500


@pytest.mark.parametrize("gaps", [1, 4, 12])
def test_pattern_and_automaton_say_the_same(scorer, gaps):
    gate = scorer.gate
    for token in tokens(800, gaps):
        assert gate.walk(token) == (gate.pattern.search(gate.plain(token)) is not None), token


@pytest.mark.parametrize("gap", [".", "²", "½.", "-²-", "." * 7, "٣", "²" * 9])
def test_one_disguise_scores_alike_at_any_length(scorer, gap):
    assert scorer.score("you " + gap.join("stupid")) == pytest.approx(0.9)


def test_letters_parted_by_commas_and_slashes(scorer):
    assert scorer.score("you s,t,u,p,i,d one") == pytest.approx(0.9) and scorer.score("you s/t/u/p/i/d") == pytest.approx(0.9)
    assert scorer.score("table, green, house") == 0


def test_the_gate_is_linear_and_an_empty_lexicon_closes_it(scorer):
    assert not scorer.gate.search("a." * 400_000) and not scorer.gate.search("s$" * 400_000)
    assert not deobfuscate.Gate(deobfuscate.Lexicon({})).search("stupid") and not deobfuscate.Gate(deobfuscate.Lexicon({})).search("stupid" * 50)
