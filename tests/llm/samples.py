"""Made-up texts with the awkward cases: nulls, empty, one word, long, repeated, shared passages, odd spaces."""

from __future__ import annotations

import random

SYLLABLES = "an ber chi do er fu ga hi in jo ka lo mi no or pa qu re st ti und von wie".split()


def prose(rng: random.Random, words: int) -> str:
    out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", ".\n"]) for w in out)


def texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    passage, other = prose(rng, 60), prose(rng, 40)
    base = prose(rng, 150)
    near = base.split(" ")
    rows: list[tuple[int | None, str | None]] = [
        (0, base), (1, base), (2, ""), (3, None), (4, "word"), (5, "word"), (6, "two words"), (7, " \t\n"),
        (8, " ".join([*near[:50], "changed", *near[51:]])), (9, " ".join([*near[:120], "other", *near[121:]])),
        (10, prose(rng, 30) + passage + prose(rng, 30)), (11, passage + prose(rng, 20)),
        (12, prose(rng, 25) + other + passage), (13, other + "\x00\x0b nul" + prose(rng, 15)),
        (14, "aaaa " * 120), (15, "ab" * 400), (16, "Größe ñandú 中文   x y　z " * 12),
        (17, prose(rng, 4000) + passage), (17, "a repeated id with another text " + prose(rng, 30)),
        (18, base), (18, base), (None, passage + "null id"), (None, None), (19, "x" * 199), (20, "x" * 200),
        (21, "y" * 201 + "z"), (-5, prose(rng, 15) + other),
    ]
    return rows
