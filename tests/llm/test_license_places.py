"""Places of the license scan against plain counting, and texts with very many of them."""

import random
import time

from rollcall.llm import license_scan


def plain_best(found):
    kept = []
    for place in sorted(found, key=lambda x: (-x[5], x[2], x[0])):
        if all(place[3] <= other[2] or other[3] <= place[2] for other in kept):
            kept.append(place)
    return sorted(kept, key=lambda x: x[2])


def test_places_apart():
    rng = random.Random(3)
    for _ in range(200):
        found = [("abc"[rng.randrange(3)], 0, a, a + rng.randint(1, 9), 1, rng.choice([0.5, 0.7, 0.9])) for a in (rng.randrange(60) for _ in range(rng.randrange(25)))]
        assert license_scan._best(found) == plain_best(found)


def test_words_are_counted_by_spaces():
    rng = random.Random(4)
    phrases = [*license_scan.BASE, *license_scan.NOTICES]
    for _ in range(50):
        text = " ".join(rng.choice([*phrases, "other", "words", "undr teh mit licence"]) for _ in range(rng.randrange(30)))
        data = license_scan.words(text)
        for _, word, start, *_ in license_scan.fuzzy_places(data):
            assert word == max(0, data.count(b" ", 0, start + 1) - 1)
        listed = data.decode().split()
        for label, word in license_scan.base_places(data):
            phrase = next(p for p, known in license_scan.BASE.items() if known == label)
            assert listed[word : word + len(phrase.split())] == phrase.split()


def test_time_follows_the_hits():
    spent = []
    for n in (8_000, 32_000):
        notice = next(iter(license_scan.NOTICES)).replace("e", "ee", 1)
        data = license_scan.words(f"cc by nc under the mit license {notice} " * (n // 7))
        started = time.process_time()
        assert len(license_scan.base_places(data)) >= 2 * (n // 7)
        assert license_scan.fuzzy_places(data)
        spent.append(time.process_time() - started)
    assert spent[1] < 10 * spent[0] + 0.5  # four times the text
