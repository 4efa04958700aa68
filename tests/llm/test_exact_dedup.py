import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isotherm.llm.exact_dedup import CountingQuotientFilter, exact_dedup, merge_entries
from llm_fixtures import clashing, doc_frame


def entries(values, bits):
    found, counts = np.unique(np.array(values, np.uint64), return_counts=True)
    return CountingQuotientFilter.build(found, counts, bits), found, counts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**20 - 1), st.integers(2**19, 2**19 + 5)), min_size=1, max_size=200))
def test_filter_gives_back_what_went_in(values):
    filled, found, counts = entries(values, 20)
    again = CountingQuotientFilter.from_bytes(filled.to_bytes())
    got, n = again.entries()
    assert got.tolist() == found.tolist() and n.tolist() == counts.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 500), min_size=1, max_size=60), min_size=1, max_size=5))
def test_merge_is_lossless(parts):
    merged, counts = merge_entries([entries(p, 12)[0].entries() for p in parts])
    whole, n = np.unique(np.concatenate(parts), return_counts=True)
    assert merged.tolist() == whole.tolist() and counts.tolist() == n.tolist()


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_groups(spark, clash):
    texts = ["a", None, "", "a", "a ", "é" * 100_000, "é" * 100_000, "b", "a"]
    ids = [3, 4, 9, 7, 8, 1, 2, None, 7]
    docs = doc_frame(spark, texts, ids)
    assert shown(exact_dedup(clashing(docs) if clash else docs)) == expected(list(zip(ids, texts, strict=True)))


def test_empty_table(spark):
    assert exact_dedup(doc_frame(spark, [])).collect() == []
