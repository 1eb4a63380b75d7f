"""Small corpora of the tests: prose, copies, near copies, odd rows."""

import random

WORDS = ("the of and to in stone river light under garden quiet morning seven paper window letter "
         "mountain bread silver road winter song table glass").split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "er", "ly", "tion", "é", "ness"])
        out.append(w + ("." if i % 11 == 10 else ",") if i % 11 in (5, 10) else w)
    return " ".join(out).replace(". ", ".\n", 3)


def corpus(seed: int = 3, n: int = 60) -> list[tuple[int, str | None]]:
    """Distinct texts, exact copies, near copies (one to many edits), shared
    passages, repeated lines, null, empty, blank, one-word and very long texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(20, 220)) for _ in range(n)]
    passage = prose(rng, 90)
    rows: list[str | None] = list(base)
    rows += [base[0], base[0], base[1], base[1][:390], base[1][:390]]
    for k in (1, 2, 4, 8, 16):
        w = base[2].split(" ")
        for _ in range(k):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(99))
        rows.append(" ".join(w))
    for k in range(6):
        rows.append(prose(rng, 30 + k) + " " + passage + " " + prose(rng, 25))
    rows += [None, "", "   \n\t ", "word", "two words", "a" * 1500, "same line\n" * 60, "ab " * 400,
             prose(rng, 4000), "x é 世界 \U0001f600 " * 40, "one two three four", "One TWO three four"]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows, strict=True))
