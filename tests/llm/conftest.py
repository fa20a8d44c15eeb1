import random

import pytest


@pytest.fixture()
def prose():
    """A maker of reproducible random texts over a small vocabulary."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["été", "größe", "the", "of"]

    def make(n, rng=rng):
        return " ".join(rng.choice(vocab) for _ in range(n))

    make.rng = rng
    return make
