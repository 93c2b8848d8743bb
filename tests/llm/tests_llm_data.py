"""Small corpora for the operators' tests."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd: random.Random, n: int, parts: str = "th er on an re he in ed nd ha at en es of or nt ea ti to it") -> str:
    own = parts.split()
    return " ".join("".join(rnd.choice(own) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def row(i, text, lang="en", source="src0"):
    return (i, text, lang, source, len(text) if text is not None else None)


def documents(seed: int = 1, n: int = 120) -> list[tuple]:
    """Prose, exact and near copies, shared passages, nulls, empties and repeated rows."""
    rnd = random.Random(seed)
    rows = [row(i, prose(rnd, rnd.randint(1, 300)), source=f"src{i % 5}") for i in range(n)]
    base = prose(rnd, 200)
    shared = prose(rnd, 150)
    for k in range(20):
        words = base.split()
        for _ in range(k % 6):
            words[rnd.randrange(len(words))] = prose(rnd, 1)
        rows.append(row(n + k, " ".join(words)))
    for k in range(10):
        rows.append(row(n + 20 + k, prose(rnd, 40) + " " + shared + " " + prose(rnd, 30)))
    rows += [row(n + 30, None), row(n + 31, ""), row(n + 32, "   \n\t "), row(n + 33, "one two"), row(n + 34, "One TWO"),
             row(n + 35, "!!! 123"), row(n + 36, prose(rnd, 20000)), row(n + 37, "Sher " * 500), row(n + 38, "é" * 900),
             row(n + 39, None, None, None), row(None, base), row(3, rows[3][1]), row(3, rows[3][1])]
    return rows
