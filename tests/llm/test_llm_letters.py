"""What the toxicity network learns beyond the evidence of single words and letter groups."""

import numpy as np
import pyarrow as pa
import pytest

from tickmart.llm import toxicity

LETTERS = list("abcdefghijklmnopqrstuvwxyz")


def word(rng, n):
    return "".join(rng.choice(LETTERS, n))


def by_word_order(n, seed):
    """Toxic where one word comes before the other; both words are in every text."""
    rng, rows = np.random.default_rng(seed), []
    filler = [word(np.random.default_rng(k), 5) for k in range(40)]
    for y in rng.integers(0, 2, n):
        words = list(rng.choice(filler, 8))
        words[int(rng.integers(0, 4))], words[int(rng.integers(4, 8))] = ("grim", "calm") if y else ("calm", "grim")
        rows.append((" ".join(words), int(y)))
    return rows


def by_letter_order(n, seed):
    """Toxic where q comes two letters before z; every text has a new word with both, and no group of five bytes recurs often."""
    rng, rows = np.random.default_rng(seed), []
    for y in rng.integers(0, 2, n):
        a, b = ("q", "z") if y else ("z", "q")
        telling = word(rng, 3) + a + word(rng, 1) + b + word(rng, 3)
        rows.append((" ".join([word(rng, 6), telling, word(rng, 6)]), int(y)))
    return rows


def fitted(rows, **settings):
    return toxicity.train(pa.array([t for t, _ in rows]), np.array([y for _, y in rows], float), **settings)


def evidence_only(model, texts):
    """The greatest evidence on a word of each text."""
    out = []
    for text in texts:
        data, offsets = toxicity.column_buffer(pa.array([text]))
        low, starts, ends, _ = toxicity.plain_words(data, offsets)
        groups, heads = toxicity.letter_groups(low, starts, ends)
        told = dict(zip(model["known"].tolist(), model["evidence"].tolist()))
        words = [told.get(h, 0.0) for h in toxicity.word_hashes(low, starts, ends).tolist()]
        out.append(float((np.array(words) + np.maximum.reduceat(model["groups"][groups], heads)).max()))
    return np.array(out)


def best_accuracy(score, y):
    """Accuracy of the best cut there is, on the judged rows themselves."""
    return max(((score >= cut) == y).mean() for cut in [*score, np.inf])


@pytest.mark.parametrize("make", [by_word_order, by_letter_order])
def test_network_beats_evidence_alone_on_held_out_rows(make):
    model = fitted(make(1500, 1))
    held = make(400, 2)
    texts, y = [t for t, _ in held], np.array([bool(y) for _, y in held])
    network = ((toxicity.text_scores(model, pa.array(texts)) >= 0.5) == y).mean()
    alone = best_accuracy(evidence_only(model, texts), y)
    assert network >= 0.9 and network >= alone + 0.1


def sequences(words):
    data, offsets = toxicity.column_buffer(pa.array([" ".join(words)]))
    low, starts, ends, _ = toxicity.plain_words(data, offsets)
    return toxicity.letter_sequences(low, starts, ends), toxicity.letter_groups(low, starts, ends)[1]


def test_sequences_hold_each_word_between_marks():
    (letters, at), heads = sequences(["ab", "c"])
    assert letters.tobytes() == b"\x01ab\x02\x02\x02\x01c\x02\x02\x02"
    assert at.tolist() == [0, 1, 6] and heads.tolist() == [0, 2]


def test_letter_inputs_do_not_depend_on_the_step(monkeypatch):
    words = ["a", "plain" * 9, "b", "word", "x" * 100, "é漢"]
    (letters, at), heads = sequences(words)
    w = toxicity.new_weights(1, 3)
    whole = toxicity.letter_inputs(w, letters, at, heads)
    for step in (1, 7, 64):
        monkeypatch.setattr(toxicity, "LETTER_STEP", step)
        assert np.array_equal(toxicity.letter_inputs(w, letters, at, heads), whole)
    for k, one in enumerate(words):
        (alone, spots), head = sequences([one])
        assert np.array_equal(toxicity.letter_inputs(w, alone, spots, head)[0], whole[k])


def test_filter_gradients_match_differences():
    (letters, at), heads = sequences(["abcab", "zz", "q"])
    w = {k: v.astype(np.float64) for k, v in toxicity.new_weights(1, 4).items()}
    side = np.random.default_rng(5).standard_normal((3, toxicity.CHAR_DIM))

    def loss():
        out = toxicity.convolved(w, letters, at)
        return float((np.maximum.reduceat(out, heads, axis=0) * side).sum())

    g = toxicity.letter_gradients(w, letters, at, heads, side)
    spots = [("char", (k, c, d)) for k, c, d in [(0, 1, 0), (1, ord("a"), 3), (2, ord("z"), 5), (4, 2, 7), (3, ord("c"), 1)]]
    for key, spot in [*spots, ("char_c", (2,))]:
        before = w[key][spot]
        w[key][spot] = before + 1e-6
        up = loss()
        w[key][spot] = before - 1e-6
        down = loss()
        w[key][spot] = before
        assert abs((up - down) / 2e-6 - g[key][spot]) < 1e-6


def by_marked_words(n, toxic, seed):
    """Long texts of random words; toxic ones hold four of ten marked words."""
    rng, rows = np.random.default_rng(seed), []
    marked = [word(np.random.default_rng(1000 + k), 6) for k in range(10)]
    for i in range(n):
        words = [word(rng, int(rng.integers(3, 9))) for _ in range(60)]
        if i < toxic:
            for at, w in zip(rng.choice(60, 4, replace=False), rng.choice(marked, 4, replace=False)):
                words[at] = w
        rows.append((" ".join(words), int(i < toxic)))
    return rows


@pytest.mark.parametrize("seed", [8, 9])
def test_few_toxic_rows_are_enough_for_marked_words(seed):
    model = fitted(by_marked_words(240, 30, seed=1), seed=seed)
    new = by_marked_words(200, 100, seed=2)
    predicted = toxicity.text_scores(model, pa.array([t for t, _ in new])) >= 0.5
    y = np.array([y for _, y in new]) == 1
    assert predicted[y].mean() >= 0.95
    assert predicted[~y].mean() <= 0.03
