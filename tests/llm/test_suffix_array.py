"""Induced sorting against plain sorting."""

import random

import numpy as np

from abacist.llm.suffix_array import common_prefixes, suffix_array


def check(text):
    order = suffix_array(text, int(text.max()) + 1)
    symbols = text.tolist()
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    shared = common_prefixes(text, order, 10)
    for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
        same = 0
        while same < 10 and symbols[a + same] == symbols[b + same]:
            same += 1
        assert shared[b] == same


def test_random_and_periodic_texts():
    rng = random.Random(1)
    for trial in range(400):
        part = [rng.randrange(1, 1 + rng.randrange(1, 6)) for _ in range(rng.randrange(0, 70))]
        check(np.array(part * (1 + trial % 4) + [0], np.int16))


def test_one_symbol():
    check(np.array([0], np.int16))
    check(np.array([3] * 50 + [0], np.int16))
