import base64
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from isotherm.llm.byte_bpe import ByteBpe, RankQueue, decode_ids, encode_texts, merge, token_digests
from llm_fixtures import clashing, doc_frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")

TEXTS = [
    "",
    None,
    " ",
    "\n",
    "a",
    "Hello, world!  two  spaces",
    "tab\tand\r\nlines\n\n\nmore \n end ",
    " lead",
    "trail ",
    "it's we'll 'sx I'M don't",
    "1234567890 ½ ٣",
    "ÀÉÎ naïve straße 日本語 テスト 🤖👩‍👩‍👧  x y",
    "<|endoftext|> </s>",
    "á é ́",
    "x" * 5000,
    "word\x0bvt\x1cfs\x85nel",
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_merge(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_merge_by_any_ranks():
    """Rank orders that no training would give: longer tokens before their parts."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        tokens = {bytes(rng.choice(list(b"abc"), rng.integers(2, 6)).tolist()) for _ in range(rng.integers(1, 25))}
        order = rng.permutation(600)[: len(tokens)] + 3
        ranks = {b"a": 0, b"b": 1, b"c": 2} | {t: int(r) for t, r in zip(sorted(tokens), order, strict=True)}
        queue = RankQueue(700)
        for _ in range(5):
            piece = bytes(rng.choice(list(b"abc"), rng.integers(1, 30)).tolist())
            assert merge(piece, ranks, queue) == ([ranks[piece]] if piece in ranks else plain_merge(piece, ranks))
        assert not any(queue.leaves) and not any(queue.buckets)


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_ids_as_the_library(library, text):
    bpe = ByteBpe(PATH, public_tokenizers.PATTERN)
    ids = np.frombuffer(bpe.encode(text), "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_random_pieces(library):
    rng, bpe = np.random.default_rng(6), ByteBpe(PATH, public_tokenizers.PATTERN)
    for _ in range(300):
        text = "".join(rng.choice(list("aeinorst \n'12é.,"), rng.integers(1, 80)))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_very_long_pre_token(library):
    bpe, text = ByteBpe(PATH, public_tokenizers.PATTERN), "".join(np.random.default_rng(7).choice(list("abcdehorst"), 200_000))
    began = time.perf_counter()
    ids = merge(text.encode(), bpe.ranks, bpe.queue)
    assert time.perf_counter() - began < 30
    assert bpe.decode(np.array(ids, "<u4").tobytes()) == text.encode()
    assert merge(text[:3000].encode(), bpe.ranks, bpe.queue) == library.encode_ordinary(text[:3000])


def test_frames(spark, library):
    docs = clashing(doc_frame(spark, [*TEXTS, "dup", "dup"], [*range(len(TEXTS)), 1, None]))
    encoded = encode_texts(docs, PATH, public_tokenizers.PATTERN)
    rows = {repr(r.doc_id) + repr(r.ids) for r in encoded.collect()}
    assert len(rows) >= len(TEXTS)
    for row in encoded.where("doc_id <> 1").collect():
        assert list(row.ids) == library.encode_ordinary(TEXTS[row.doc_id] or "")
    data = {r.doc_id: bytes(r.data) for r in decode_ids(encoded.where("doc_id <> 1"), PATH, public_tokenizers.PATTERN).collect()}
    assert all(data[i] == (t or "").encode() for i, t in enumerate(TEXTS) if i != 1)
    assert token_digests(docs, PATH, public_tokenizers.PATTERN).count() == docs.count()
    assert token_digests(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
