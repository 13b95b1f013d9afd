"""Made-up words and texts for the tests."""

import random


def vocabulary(n=400, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(draw.randint(2, 8))) for _ in range(n)]


def prose(words, n, draw):
    return " ".join(draw.choice(words) for _ in range(n))
