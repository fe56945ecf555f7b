import random

import pytest

from llm_frames import EDGES, prose
from titlemart.llm.tables import reachable


@pytest.fixture(scope="session")
def shared(spark):
    return reachable(spark)


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages and one very long text, and the odd rows."""
    rng = random.Random(11)
    passage = prose(rng, 160)
    rows: list[tuple] = []
    for i in range(160):
        kind = rng.random()
        if rows and kind < 0.15:
            text = rows[rng.randrange(len(rows))][1]
        elif rows and kind < 0.4:
            words = rows[rng.randrange(len(rows))][1].split() or ["w"]
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = "edited"
            text = " ".join(words)
        else:
            words = prose(rng, rng.randrange(0, 150))
            if rng.random() < 0.4:
                at, cut = rng.randrange(len(words) + 1), rng.randrange(90)
                words[at:at] = passage[cut : cut + rng.randrange(40, 70)]
            text = (" " if i % 3 else "\n ").join(words)
        rows.append((i, text))
    rows.append((500, " ".join(prose(rng, 6000)) + " " + " ".join(passage)))
    rows.append((501, "same " * 700))
    rows += EDGES
    rng.shuffle(rows)
    return rows
