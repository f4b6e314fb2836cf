"""Packing, token counts and chunked BPE against the libraries themselves."""
import base64
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from triagekit.llm import bpe, packing, token_counts

from .conftest import path, pattern

TEXTS = [(1, "Hello world, it's fine."), (2, None), (3, ""), (4, "a  b\n\n c \t d  "), (5, "x <|endoftext|> y  <|endoftext|>"),
         (6, "Straße naïve 東京 🙂🙂 é " * 40), (7, "word " * 3000), (8, "'s 're '' don't " * 20), (7, "word " * 3000),
         (None, "null id"), (9, " "), (10, " x    y\x1c z")]


def tiktoken_encoding(name):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path(name), "rb"))}
    return tiktoken.Encoding("t", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})


def hf(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path(name))


# --- packing -------------------------------------------------------------------------------

def sequences(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    return bins


def check_sequences(rows, cap):
    for parts in sequences(rows).values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap.tokens and len(parts) <= cap.documents
        assert sum(n * n for _, n in parts) <= cap.attention


def test_pack_documents_matches_the_tokenizer(documents):
    t = hf("byte_bpe_50k.json")
    got = packing.pack_documents(documents(TEXTS), path("byte_bpe_50k.tiktoken"), pattern(), (("<|endoftext|>", 50256),), 2).collect()
    expected = []
    for doc, text in TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) % 1024 or 1024) if len(ids) > 1024 else len(ids)
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            expected.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(expected, key=key)
    check_sequences(got, packing.Capacity())


def test_pack_empty_table(documents):
    out = packing.pack_documents(documents([]), path("byte_bpe_50k.tiktoken"), pattern(), (), 2)
    assert out.count() == 0 and "sequence_id" in out.columns


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1), st.sampled_from(["norm", "dot"]),
       st.integers(2, 64), st.integers(4096, 9000))
def test_plan_places_every_piece_once(counts, rule, documents_, attention):
    cap = packing.Capacity(64, documents_, attention, (1.0, 0.3, 0.1), rule)
    rows, bins = packing.plan(counts, cap), defaultdict(list)
    for length in counts:
        ranks = sorted((a, b) for n, a, b, *_ in rows if n == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == counts[length]
        assert all(x[1] == y[0] for x, y in zip(ranks, ranks[1:]))
    for length, a, b, seq, each, offset in rows:
        for k in range(b - a):
            bins[seq + k // each].append((offset + k % each * length, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap.tokens and len(parts) <= cap.documents and sum(n * n for _, n in parts) <= cap.attention


def test_plan_is_best_fit_decreasing():
    """One binding constraint: the plan uses as many sequences as plain best fit decreasing."""
    rng = random.Random(4)
    lengths = [min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(800)]
    left = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in left if r >= n]
        if fit:
            left.remove(min(fit))
            left.append(min(fit) - n)
        else:
            left.append(1024 - n)
    rows = packing.plan({n: lengths.count(n) for n in set(lengths)})
    assert len({s + k // e for _, a, b, s, e, _ in rows for k in range(b - a)}) == len(left)


def test_plan_refuses_what_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({5: 1}, packing.Capacity(tokens=4))


def test_pack_spreads_a_hot_length(spark):
    pieces = spark.range(2000).selectExpr("id as doc_id", "0 as piece", "if(id % 3 = 0, 7L, id % 11 + 1) as length")
    got = packing.pack(pieces, packing.Capacity(tokens=32, documents=5, attention=1024)).collect()
    assert len(got) == 2000
    check_sequences(got, packing.Capacity(32, 5, 1024))


# --- token counts --------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_match_the_library(documents, name):
    rows = [(i, t) for i, t in TEXTS]
    got = token_counts.count_tokens(documents(rows), path(name), table_size=8).collect()
    if name.endswith(".model"):
        import sentencepiece
        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path(name)).encode(t))
    else:
        count = lambda t: len(hf(name).encode(t, add_special_tokens=False).ids)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(
        [(i, len((t or "").encode()), count(t or "")) for i, t in rows], key=key)


def test_frequent_pieces_cover_all_texts(documents):
    docs = documents([(i, "the cat " * 5 + f"w{i}") for i in range(50)])
    top = token_counts.frequent(docs, size=2)
    assert list(top) == ["cat", "the"] and top["the"] == 250
    assert token_counts.count_tokens(documents([]), path("word_bpe_49k.json")).count() == 0


# --- chunked BPE ---------------------------------------------------------------------------

def encoded(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0), array("I", r.ids).tolist()) for r in frame.collect())


def test_chunks_encode_like_whole_texts(documents):
    enc = tiktoken_encoding("byte_bpe_multi_50k.tiktoken")
    rng = random.Random(5)
    parts = ["word", " ", "\n", "  \n ", "'", "'re", "'s", "ll", "123", "é", "東京", "!!", "\t", "🙂", " a", " "]
    rows = TEXTS + [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 300)))) for i in range(60)]
    rows += [(300, "a" * 500), (301, " " * 400), (302, "a" * 90 + " " + "b" * 200 + " c" * 40), (303, "1" * 333 + "x")]
    p = path("byte_bpe_multi_50k.tiktoken")
    got = bpe.encode(documents(rows), p, pattern(), chunk=48, overlap=16)
    assert encoded(got) == sorted(((i is None, i or 0), enc.encode_ordinary(t or "")) for i, t in rows)
    back = bpe.decode(got, p, pattern()).collect()
    assert sorted((bytes(r.decoded) for r in back)) == sorted((t or "").encode() for _, t in rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ab", " ", "  ", "\n", "'", "'re", "'ll", "12", "é", "!", "\t", "x"]), max_size=60), st.integers(2, 20))
def test_stitches_are_boundaries_of_the_whole_text(parts, overlap):
    compiled, text, chunk = regex.compile(pattern()), "".join(parts), 20
    true = {m.end() for m in compiled.finditer(text)} | {0}
    begin = 0
    for k in range(-(-len(text) // chunk) - 1):
        stop = bpe.stitch(compiled, text[k * chunk:(k + 1) * chunk + overlap], chunk, overlap)
        if stop is None:
            break
        begin = k * chunk + stop
        assert begin in true


def test_empty_table(documents):
    assert bpe.encode(documents([]), path("byte_bpe_multi_50k.tiktoken"), pattern()).count() == 0
