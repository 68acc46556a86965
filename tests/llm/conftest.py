import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def prose():
    """A seeded generator of sentences over a small vocabulary."""
    def make(seed, n_words, vocabulary=400):
        r = random.Random(seed)
        words = ["".join(random.Random(k).choices("aeioustrnl", k=3 + k % 6)) for k in range(vocabulary)]
        return " ".join(r.choice(words) for _ in range(n_words))
    return make


@pytest.fixture
def edge_docs(prose):
    """Null, empty and blank texts, one very long text, ties, repeated rows."""
    long = "\n".join(prose(900 + k, 40) for k in range(400))
    a = prose(1, 60)
    return [(5, a), (5, a), (3, a), (7, a + " "), (8, None), (9, ""), (10, " \n\t "), (11, "\n\n"), (12, long),
            (None, prose(2, 30)), (None, a), (14, "x"), (15, "ümläut ★ " + prose(3, 20)), (16, prose(4, 80)),
            (17, "12 345 !!"), (18, prose(4, 80).replace(" ", "\n", 5))]
