"""Brute-force helpers of the tests."""

import random
import re


def words_of(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def prose(n, seed, size=400):
    """``n`` words that differ from seed to seed."""
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgklmn')}{rng.choice('aeiou')}{rng.randrange(size)}" for _ in range(n))
