import random

import numpy as np
from helpers import words
from test_op07_spaced_seeds import run

from fieldloom.llm.spaced_seeds import MISS, best_segment


def segments(equal):
    """The best prefix of each stretch that ends where the running score falls to 0."""
    out, score, s, best = [], 0, 0, (0, 0, 0)
    for i, x in enumerate([*equal, None]):
        score = score + 1 if x else score - MISS
        if x is None or score <= 0:
            if best[0]:
                out.append(best)
            score, s, best = 0, i + 1, (0, 0, 0)
        elif score > best[0]:
            best = (score, s, i + 1)
    return out


def test_every_segment_is_looked_at():
    rng, looked = random.Random(3), 0
    for _ in range(4000):
        equal = [rng.random() < 0.75 for _ in range(rng.randint(0, 60))]
        least = rng.randint(0, 15)
        a, z = best_segment(np.array(equal, dtype=bool))
        if sum(equal[a:z]) < least:  # the best one of all is too short
            fit = [x for x in segments(equal) if sum(equal[x[1]:x[2]]) >= least]
            if fit:
                a, z = max(fit, key=lambda x: (x[0], -x[1]))[1:]
                looked += 1
        assert best_segment(np.array(equal, dtype=bool), least) == (a, z)
    assert looked > 5


def test_clean_words_do_not_hide_a_longer_segment(spark):
    item = words(random.Random(2), 30, 10**6).split()
    text = list(item)
    for i in (*range(12, 16), 23):
        text[i] = "other"  # 12 matches, 4 misses, 7 matches, 1 miss, 6 matches
    assert run(spark, [(1, " ".join(text))], [(5, " ".join(item))]) == [(1, 5, 13, 14, 16, 16)]
