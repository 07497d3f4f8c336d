from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from barline.llm.byte_bpe import decode_ids, encode_texts, from_ranks, merge  # noqa: E402
from barline.llm.pretokens import automaton, piece_starts  # noqa: E402
from barline.llm.ragged import code_points  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TRICKY = ["", " ", "  ", "\n", "a", "'s", "it's", "IT'S", "x''s", "!'s", " 's", "\n's", "'re're", "'r", "'l l", "a  b", "a \n b",
          "a\n\nb", "end  ", "12a34", " \t x", "٣٤ ", "漢字。漢", "🎉🎉 !!", "a　b", "\x1c\x85", "ᛔ0\U00016d40", "<|endoftext|>"]


@pytest.fixture(scope="module")
def known():
    bpe = from_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def as_bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def test_encodes_like_the_library(known):
    rng = random.Random(1)
    alphabet = list("ab'stmdrevl  \n\t\r !.?1٣é漢\U0001f389\x1c\x85") + ["'s", "'re", "'ll", "  "]
    texts = TRICKY + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    bpe = from_ranks(PATH)
    for text, made in zip(texts, bpe.encode(texts)):
        assert made == as_bytes(known.encode_ordinary(text)), repr(text)
        assert bpe.decode(made) == text.encode()


def test_pieces_equal_the_pattern():
    regex = pytest.importorskip("regex")
    pattern = regex.compile(public_tokenizers.PATTERN)
    bpe = from_ranks(PATH)
    for text in TRICKY[:-2]:
        assert bpe.spans(text) == [m.span() for m in pattern.finditer(text)], repr(text)


def test_scan_is_associative_and_crosses_blocks(known):
    product = automaton()[1]
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(0, len(product), (3, 500))
    assert (product[product[a, b], c] == product[a, product[b, c]]).all()
    text = "ab 's  \n" * 2000
    points, at = code_points([text])
    starts = piece_starts(points, at[1:] - 1)
    lengths = [len(known.decode([i])) for i in known.encode_ordinary(text)]
    assert len(starts) - 1 <= len(lengths) and starts[-1] == len(text)


def test_long_pieces_and_offsets(known):
    bpe = from_ranks(PATH)
    for piece in ("x" * 3000, "abcé" * 500, "aaaa" * 30):
        assert as_bytes(merge(piece.encode(), bpe.ranks)) == as_bytes(known.encode_ordinary(piece))
    ids = bpe.encode(["héllo wörld"])[0]
    offsets = bpe.decode_offsets(ids)
    assert offsets[0] == 0 and offsets[-1] == len("héllo wörld".encode()) and (np.diff(offsets) > 0).all()


def test_rows(spark, docs_of, known):
    rows = [(1, "Hello there's 42"), (2, None), (3, ""), (1, "Hello there's 42"), (None, "x"), (4, "word " * 30_000)]
    made = encode_texts(docs_of(rows, extra=True), PATH, digests=True).collect()
    want = sorted((i is None, i or 0, len(ids := known.encode_ordinary(t or "")), hashlib.sha256(as_bytes(ids)).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in made) == want
    back = decode_ids(encode_texts(docs_of(rows), PATH).drop("offsets"), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert encode_texts(docs_of([]), PATH, digests=True).count() == 0
