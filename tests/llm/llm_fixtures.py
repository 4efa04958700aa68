"""Brute-force twins and small tables for the tests of the llm operators."""

import re

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_frame(spark, texts, ids=None, lang="en"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, "src", None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC_COLUMNS)


def clashing(docs):
    """The same rows with extra columns named like columns that operators use inside."""
    extra = "node label key tag bucket word first starts fingerprint text_sha256 kept place score rank carried task length a b".split()
    return docs.selectExpr("*", *(f"'x' AS {name}" for name in extra))


def shingle_set(text, words):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not found:
        return frozenset()
    size = min(words, len(found))
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def components(ids, linked):
    """Smallest id reachable from each id, by all pairs."""
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(ids)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(a, b):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def repeated_bytes(texts, length):
    """Per text: which bytes a string of that length covers that also starts elsewhere."""
    seen = {}
    for data in texts:
        for i in range(len(data) - length + 1):
            seen[data[i : i + length]] = seen.get(data[i : i + length], 0) + 1
    out = []
    for data in texts:
        marks = [False] * len(data)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                marks[i : i + length] = [True] * length
        out.append(marks)
    return out
