"""The null of the secret scan: all prose, tested in bulk as tokens are tested one by one."""

import random

import numpy as np

from cases import frame
from shelfline.llm import secrets

LETTERS = "etaoinshrdluETAOINcmfwypvbgk0123456789"


def words(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_steps_in_bulk_are_those_of_single_cuts():
    rng = random.Random(3)
    for length in (20, 31, 40, 63, 64):
        alphabets = [LETTERS, "0123456789", "0123456789abcdef", "ab", "A", "abcdefghijklmnopqrstuvwxyz", "01234567Ab"]
        cuts = ["".join(rng.choice(rng.choice(alphabets) if i % 2 else alphabets[i % 7]) for _ in range(length)) for i in range(300)]
        cuts += ["a" * length, "a" * (length - 1) + "b"]
        found = secrets.cut_steps(np.array([list(c.encode()) for c in cuts], np.uint8))
        assert found.tolist() == [secrets._step(secrets.randomness(c)[1]) for c in cuts]


def test_all_prose_is_cut_end_to_end():
    rng = random.Random(5)
    texts = [words(rng, 200), None, words(rng, 3), words(rng, 700)]
    lengths = {6: [40, 33] * 32, 7: [64] * 64}
    found = secrets.prose_cuts(texts, lengths)
    letters = sum(len(secrets.prose_of(t or "")) for t in texts)
    cuts = {name: sum(n for (own, _), n in found.items() if own == name) for name in lengths}
    # What is left over at the end of a text is less than a cut; the short text is joined to the last.
    assert cuts[7] * 64 <= letters < (cuts[7] + 2) * 64 and cuts[6] * 36.5 - 40 <= letters < (cuts[6] + 3) * 36.5 + 40


def test_limits_come_from_all_prose(spark, monkeypatch):
    rng = random.Random(7)
    text = words(rng, 40_000)
    docs = [(i, text[i:]) for i in range(8)] + [(8, "k7Qz2Lx9Rt5Vb1Nw8Yp4Mc6Hd3Jf0Gs2Ka9Xe7Tu")]
    counted, p_values = [], secrets.p_values
    monkeypatch.setattr(secrets, "p_values", lambda prose: counted.append(sum(prose.values())) or p_values(prose))
    secrets.scan(frame(spark, docs))
    letters = sum(len(secrets.prose_of(t)) for _, t in docs)
    assert letters > 1_200_000 and len(counted) == 1
    assert (counted[0] + 9) * 40 > letters
