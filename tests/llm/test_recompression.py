import random
import re
from collections import Counter

import numpy as np
import pytest

from isotherm.llm import recompression
from llm_fixtures import clashing, doc_frame


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def brute_force(rows, length):
    """Results of rows ``(id, text)`` whose order by id, then as given, is settled."""
    seen, out = set(), []
    for i, text in sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0])):
        words = split(text[1])
        gone = [False] * len(words)
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            if window in seen:
                gone[at : at + length] = [True] * length
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append((text[0], len(words), sum(gone), kept))
    return Counter(out)


def found(spark, rows, length=20, context=10, **options):
    docs = doc_frame(spark, [r[1] for r in rows], [r[0] for r in rows])
    return Counter(tuple(r) for r in recompression.cut_later(docs, length, context, **options).collect())


def texts(seed, n, words, most):
    """Texts of shared passages, single words and runs."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["ü", "a", "aa"]
    passages = [[pick.choice(vocabulary) for _ in range(pick.randrange(1, 60))] for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        while len(parts) < pick.randrange(most):
            kind = pick.random()
            parts += pick.choice(passages) if kind < 0.4 else [pick.choice(vocabulary)] * pick.randrange(1, 30) if kind < 0.5 else pick.choices(vocabulary, k=9)
        out.append("".join(w + pick.choice([" ", "\n", "\t ", "\x0b"]) for w in parts))
    return out


@pytest.mark.parametrize("seed,words,length,context", [(1, 200, 20, 10), (2, 2, 20, 10), (3, 30, 6, 3), (4, 5, 8, 5), (5, 1, 4, 2)])
def test_equals_brute_force(spark, seed, words, length, context):
    rows = list(enumerate(texts(seed, 60, words, 150)))
    assert found(spark, rows, length, context) == brute_force(rows, length)


def test_nulls_empty_short_and_long_texts(spark, monkeypatch):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "w " * 19), (4, "w " * 20), (5, "w " * 21), (6, "x" * 5000), (None, "y z " * 30)]
    monkeypatch.setattr(recompression, "PART_BYTES", 64)
    rows += [(10 + i, t) for i, t in enumerate(texts(6, 12, 40, 900))]
    assert found(spark, rows) == brute_force(rows, 20)


def test_repeated_rows_and_shared_ids(spark):
    one, two, three = texts(7, 3, 50, 200)
    rows = [(5, one)] * 40 + [(None, two)] * 30 + [(None, "short text")] * 3 + [(6, three), (7, one + two)]
    assert found(spark, rows) == brute_force(rows, 20)


def test_anchor_depends_on_its_window_alone():
    scanner = recompression.Scanner(20, 10, 3)
    pick = random.Random(8)
    inner = [pick.choice("abcdefgh") for _ in range(20)]

    def anchor(before, after):
        words = scanner.words([" ".join(before + inner + after).encode()], [10**6])
        worth = scanner.anchors(words)[len(before) : len(before) + 11]
        return int(worth.max()), int(np.argmax(worth))

    seen = {anchor([pick.choice("abch") for _ in range(pick.randrange(9))], [pick.choice("abch") for _ in range(pick.randrange(9))]) for _ in range(200)}
    assert len(seen) == 1


def test_empty_table_and_clashing_columns(spark):
    assert recompression.cut_later(doc_frame(spark, [])).collect() == []
    rows = list(enumerate(texts(9, 20, 60, 120)))
    docs = clashing(doc_frame(spark, [t for _, t in rows]))
    assert Counter(tuple(r) for r in recompression.cut_later(docs).collect()) == brute_force(rows, 20)
