"""Small tables with awkward rows, and plain versions of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, root int, id string, rate double"
WORD = re.compile("[^\x20\x09-\x0d]+")


def sentence(rng: random.Random, letters: str, n: int) -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def awkward_documents(seed: int = 1) -> list[tuple]:
    """Null, empty, wordless, short and very long texts, copies, near copies,
    shared passages, a null id and repeated rows."""
    rng = random.Random(seed)
    base = [sentence(rng, "etaoinsr", 120) for _ in range(12)]
    texts = [None, "", " \n\t ", "12 34 !!", "one", "One two", "ONE TWO", *base, base[0], base[0].upper()]
    near = base[1].split()
    near[60] = "changed"
    texts.append(" ".join(near))
    passage = sentence(rng, "ädcbfghl", 70)
    texts += [f"{sentence(rng, 'mnpqrs', 40)} {passage} {sentence(rng, 'tuvwx', 30)}" for _ in range(3)]
    texts.append(passage + "\n" + sentence(rng, "abcdef", 40))
    texts.append(sentence(rng, "etaoin", 30_000))
    texts.append("x" * 50_000)
    rows = [(i, t, "l1" if i % 3 else None, "s", len(t or ""), "n", 7, "i", 0.5) for i, t in enumerate(texts)]
    return [*rows, (None, base[2] + " end", "l2", "s", 3, "n", 7, "i", 0.5), rows[8], rows[8]]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
