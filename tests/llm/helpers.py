"""Small documents with every awkward case, and plain versions of the operators to compare with."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, id bigint, score double, digest string, n bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward(n: int = 60, seed: int = 3) -> list[tuple]:
    """Nulls in every column, empty and long texts, exact and near copies, repeated rows and ids, clashing column names."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(80)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(110))
    texts: list[str | None] = [None, "", " \t\n", "one", "one two three four", "ONE two Three Four", "x" * 3000, "word " * 4000]
    for i in range(n):
        body = [rng.choice(vocabulary) for _ in range(rng.choice((3, 5, 30, 120, 300)))]
        if i % 5 == 1:
            body.insert(len(body) // 2, passage)
        if i % 7 == 2 and texts[-1]:
            body = texts[-1].split(" ")
            body[rng.randrange(len(body))] = "changed"
        if i % 9 == 4:
            body = (texts[-2] or "").split(" ")
        texts.append(" ".join(body))
    rows = [(i, t, "en", ("a", "b", None, "hot")[min(i % 9, 3)], len(t or ""), -i, 7, 0.5, "clash", 1) for i, t in enumerate(texts)]
    rows.append((None, "no id at all", None, None, None, None, None, None, None, None))
    rows.append((3, "an id that occurs twice", None, "a", 3, None, None, None, None, None))
    rows += [rows[20], rows[20], rows[-1]]
    return rows


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
