"""Both encoders against the libraries that own the vocabularies."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillmere.llm import byte_bpe, token_counts

WORDS, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
library = Tokenizer.from_file(WORDS)
own = token_counts.counter(WORDS)
coder = byte_bpe.coder(RANKS, P.PATTERN)
other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})

count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
any_text = st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("abcdeghilnorst' \n.0éΣ<|>", max_size=80)


@settings(max_examples=400, deadline=None)
@given(any_text)
def test_both_equal_the_libraries(text):
    assert own.count(text) == count(text)
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


@settings(max_examples=120, deadline=None)
@given(st.lists(any_text | st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|endof", "!!"]), max_size=5))
def test_count_at_every_prefix(parts):
    text = own.normal("".join(parts))
    p = own.prefixes(text)
    known = [p.count(k) for k in range(len(text) + 1)]
    assert known == [count(text[:k]) for k in range(len(text) + 1)] and p.total == known[-1]
    for budget in range(12):
        assert p.longest(budget) == max(k for k, n in enumerate(known) if n <= budget)


def test_a_text_is_tokenised_once(monkeypatch):
    p = own.prefixes("Some words, and more of them <|endoftext|> here's the end. " * 500)
    text = own.normal("Some words, and more of them <|endoftext|> here's the end. " * 500)
    want = {k: count(text[:k]) for k in range(0, len(text), 997)}
    p.at()
    for name in ("counts_of", "_prefix_counts", "_last", "_inner", "segments", "normal"):
        monkeypatch.setattr(token_counts.PrefixCounter, name, None)
    monkeypatch.setattr(own, "pattern", None)
    assert {k: p.count(k) for k in want} == want
    assert all(p.count(p.longest(b)) <= b < p.count(p.longest(b) + 1) for b in range(0, p.total, 131))


@pytest.mark.parametrize("text", ["a" * 30000, " " * 30000 + "x", "ab" * 20000, "\n" * 9999, "é" * 9999, "0" * 3000, "x " * 1_200_000])
def test_long_runs(text):
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == other.encode_ordinary(text)
    if len(text) < 20000:
        assert own.count(text) == count(text)


@pytest.mark.parametrize("space", ["\n\n", "  ", " \n \t "])
def test_white_space_anywhere_in_a_long_text(space):
    text = ("ab " * 333_333)[: 1_000_000 - len(space) - 1] + "x" + space + "Next " * 300_000
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == other.encode_ordinary(text)
    many = ("word" + space) * 450_000  # wherever a batch ends
    assert np.frombuffer(coder.encode(many), "<u4").tolist() == other.encode_ordinary(many)


def test_neighbours_equal_plain_merging():
    r = random.Random(2)
    some, letters = r.sample(sorted(coder.bytes_of), 1500), sorted(own.vocab)
    words = [w for w in r.sample(letters, 1500) if not w.startswith("<|")]
    near = [(a, b) for a in some[:300] for b in r.sample(some, 12)] + [(a, a) for a in some]
    near += [(coder.ranks[x[:k]], coder.ranks[x[k:]]) for x in map(coder.bytes_of.get, some) for k in range(1, len(x)) if x[:k] in coder.ranks and x[k:] in coder.ranks]
    for a, b in near:
        assert coder.fits(a, b) == (coder.merged(coder.bytes_of[a] + coder.bytes_of[b]) == [a, b])
    for a in words:
        for b in r.sample(words, 3):
            if not a.endswith("</w>"):
                assert own.fits(a, b) == (own.merged([*own.symbols(a), *own.symbols(b)]) == [a, b])
    assert all(own.fits(w) == (own.merged(own.symbols(w)) == [w]) for w in words) and all(coder.fits(i) == (coder.merged(coder.bytes_of[i]) == [i]) for i in some)


def test_memos_are_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "MEMO_PAIRS", 50)
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 50)
    monkeypatch.setattr(token_counts, "MEMO_PREFIXES", 60)
    monkeypatch.setattr(token_counts, "MEMO_PAIRS", 60)
    c, w, r = byte_bpe.ByteBPE(coder.ranks, P.PATTERN), token_counts.PrefixCounter(WORDS), random.Random(1)
    for _ in range(30):
        text = " ".join("".join(r.choices("abcdefghij", k=r.randint(1, 9))) for _ in range(40))
        assert np.frombuffer(c.encode(text), "<u4").tolist() == other.encode_ordinary(text) and w.count(text) == count(text)
    assert len(c._memo) <= 50 and len(w._counts) <= 50


def test_operators(odd, texts):
    got = sorted(token_counts.token_counts(odd, WORDS, limit=20).collect(), key=repr)
    want = [(d, len((t or "").encode()), count(t or "")) for d, t in texts]
    assert [tuple(r)[:3] for r in got] == sorted(want, key=repr) or sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, want))
    assert all(r.over_limit == (r.n_tokens > 20) and (r.cut_chars is None) != r.over_limit for r in got)
    for d, t in texts:
        short = own.normal(t or "")
        cuts = {r.cut_chars for r in got if r.doc_id == d and r.over_limit}
        assert all(count(short[:k]) <= 20 < count(short[: k + 1]) for k in cuts if d is not None)
    enc = byte_bpe.encode(odd, RANKS, P.PATTERN)
    rows = enc.collect()
    want = {}
    for d, t in texts:
        i = np.array(other.encode_ordinary(t or ""), "<u4")
        want[d] = len(i), hashlib.sha256(i.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), i.tolist()
    assert len(rows) == len(texts) and all((r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) == want[r.doc_id] for r in rows)
    back = byte_bpe.decode(enc, RANKS, P.PATTERN).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(d), t or "") for d, t in texts)


def test_empty_table(odd):
    none = odd.where("false")
    assert token_counts.token_counts(none, WORDS).count() == 0 and byte_bpe.encode(none, RANKS, P.PATTERN).count() == 0
