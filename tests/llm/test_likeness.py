"""Likeness of fingerprints against the exact generalised Jaccard similarity of texts."""

import random
from collections import Counter

import pytest

from rollcall.llm import fingerprint


def exact(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / sum((x | y).values())


@pytest.mark.parametrize("shared", [0, 8_000, 20_000])
def test_likeness_of_long_texts_is_their_similarity(shared):
    rng = random.Random(shared)
    common = [f"c{i}" for i in range(shared)]
    a, b = ([*common, *(f"{side}{i}" for i in range(20_000 - shared))] for side in "ab")
    a, b = (" ".join(w for w in words for _ in range(rng.choice((1, 1, 1, 2, 5)))) for words in (a, b))
    sampler = fingerprint.Sampler(slots=512)
    got = fingerprint.likeness(sampler.signature(a), sampler.signature(b))
    true = exact(a, b)
    assert abs(got - true) <= 4.5 * (true * (1 - true) / 512) ** 0.5 + 0.01


def test_kept_draws_change_no_result():
    text = " ".join(f"w{i % 700} v{i}" for i in range(3000))
    fresh, few, worn = fingerprint.Sampler(), fingerprint.Sampler(cached=7), fingerprint.Sampler()
    worn.signature(" ".join(f"v{i}" for i in range(5000)))
    assert (fresh.signature(text) == few.signature(text)).all() and (worn.signature(text) == few.signature(text)).all()
