"""Both BPE encoders against the library: counts, ids, prefixes, round trips."""

import hashlib
import json
import random

import numpy as np
from hypothesis import given
from hypothesis import settings as hyp
from hypothesis import strategies as st

from tablebridge.llm import bpe, bpe_codec, token_counts
from tablebridge.llm.bpe import ByteBPE, load

PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "!", "é", "ß", "中", "🙂", "<|endoftext|>", "<|", "|>", "endoftext", "1", "The", "\t", "\x1c", "\x85", "'ll", "ithe", "  ", "ः", "\U0001f9ff"]


def test_texts_like_the_library(vocabulary, library):
    coder, r = load(vocabulary), random.Random(7)
    for _ in range(1500):
        text = "".join(r.choice(PARTS) for _ in range(r.randrange(14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids and coder.count(text) == len(ids)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_vocabularies_with_tokens_that_fall_apart():
    """Merges in any order: a token's text may encode to other tokens."""
    from tokenizers import Tokenizer

    r, signs = random.Random(4), "abcd"
    for _ in range(60):
        vocab = {c: i for i, c in enumerate([*signs, "Ġ"])}
        merges = []
        for _ in range(14):
            a, b = (r.choice([t for t in vocab if "Ġ" not in t]) for _ in range(2))
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append(f"{a} {b}")
        spec = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}, "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": vocab, "merges": merges}}
        blob = json.dumps(spec).encode()
        library, coder = Tokenizer.from_str(blob.decode()), ByteBPE(blob)
        for text in [t for t in vocab if "Ġ" not in t] + ["".join(r.choice(signs) for _ in range(r.randrange(1, 14))) for _ in range(40)]:
            ids = library.encode(text, add_special_tokens=False).ids
            assert coder.encode(text) == ids and coder.count(text) == len(ids), (text, merges)


def test_known_pairs_are_looked_up_without_a_call(vocabulary, library, monkeypatch):
    coder, r = ByteBPE(vocabulary), random.Random(9)
    words = ["".join(r.choice("aeinrstlqxz") for _ in range(r.randrange(1, 30))) for _ in range(300)]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [coder.backtrack(w) for w in words] == want
    monkeypatch.setattr(coder, "fits", None)
    assert [coder.backtrack(w) for w in words] == want


def test_unknown_words_are_encoded_together(vocabulary, library, monkeypatch):
    coder, r, calls = ByteBPE(vocabulary), random.Random(11), []
    one_by_one = coder.backtrack
    monkeypatch.setattr(coder, "backtrack", lambda p: calls.append(p) or one_by_one(p))
    words = ["".join(r.choice("aeinrstlqxzéßüАж") for _ in range(r.randrange(1, 14))) + r.choice(["", ".", ",", ".\nX", "%%%", "  "]) for _ in range(3000)]
    text = " ".join([*words, "q" * 2000, "xy" * 3000])
    ids = library.encode(text, add_special_tokens=False).ids
    assert coder.encode(text) == ids and len(calls) < 100
    assert coder.decimals(coder.encode_array(text)) == ",".join(map(str, ids)).encode() and coder.decimals(coder.encode_array(None)) == b""
    texts = [None, "", " ", *(" ".join(r.sample(words, 20)) for _ in range(50)), "a\0b <|endoftext|>c"]
    for ids, t in zip(coder.encode_arrays(texts), texts, strict=True):
        assert ids.tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_array_code_backtracks_like_the_loop(monkeypatch):
    """Merges in any order, pairs that share slots, and no word left for the loop."""
    monkeypatch.setattr(bpe, "PAIR_SLOTS_LOG2", 3)
    monkeypatch.setattr(bpe, "FEW", 1)
    r, signs = random.Random(5), "abcd"
    for _ in range(40):
        vocab, merges = {c: i for i, c in enumerate([*signs, "Ġ"])}, []
        for _ in range(20):
            a, b = (r.choice([t for t in vocab if "Ġ" not in t]) for _ in range(2))
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append(f"{a} {b}")
        coder = ByteBPE(json.dumps({"pre_tokenizer": {"type": "ByteLevel"}, "model": {"type": "BPE", "vocab": vocab, "merges": merges}}).encode())
        pieces = ["".join(r.choice(signs) for _ in range(r.randrange(1, 30))) for _ in range(200)]
        want = [coder.backtrack(p) for p in pieces]
        assert [np.frombuffer(b, dtype=np.intc).tolist() for b in coder._backtrack_all(pieces)] == want


def test_known_words_stay_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 400)
    coder, r = ByteBPE(vocabulary), random.Random(12)
    for _ in range(20):
        coder.encode(" ".join("".join(r.choice("aeinrst") for _ in range(9)) for _ in range(150)))
        assert len(coder.words) + len(coder.words.old) <= 800


def test_letters_before_stops_are_cut_like_the_library(vocabulary, library):
    coder = ByteBPE(vocabulary)
    for c in map(chr, range(1, ord(bpe._STABLE) + 1)):
        for word in (f" a{c}", f"{c}a.", f" {c},"):
            want = [word[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(word)]
            assert coder._words(word) == want or [p for w in coder._words(word) for p in coder._pieces(w)] == want, (c, word)


@hyp(max_examples=150, deadline=None)
@given(st.text(max_size=24))
def test_any_text(vocabulary, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    coder = load(vocabulary)
    assert coder.encode(text) == ids and coder.decode(ids) == text


def test_every_prefix(vocabulary, library):
    coder, r = load(vocabulary), random.Random(8)
    for _ in range(300):
        text = "".join(r.choice(PARTS) for _ in range(r.randrange(12)))
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert coder.prefix_counts(text).tolist() == want


def test_parts_of_characters_decode_to_replacements(vocabulary, library):
    coder = load(vocabulary)
    for ids in ([128], [100, 200, 50256], list(range(120, 256)), []):
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_odd_rows(odd, empty, vocabulary, library):
    got = token_counts.token_counts(odd, vocabulary).collect()
    rows = odd.collect()
    assert len(got) == len(rows)
    for g, r in zip(got, rows, strict=True):
        text = r.text or ""
        assert (g.doc_id, g.n_bytes, g.n_tokens) == (r.doc_id, len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
    assert token_counts.token_counts(empty, vocabulary).count() == 0
    for g, r in zip(bpe_codec.round_trip(odd, vocabulary).collect(), rows, strict=True):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe_codec.decode(bpe_codec.encode(odd, vocabulary), vocabulary).collect()
    assert [b.text for b in back] == [r.text or "" for r in rows]
    assert bpe_codec.encode(empty, vocabulary).count() == 0


def test_budgets(odd, vocabulary, library):
    short = odd.where("length(text) < 100 or text is null")
    for r, p, t in zip(short.collect(), token_counts.prefix_token_counts(short, vocabulary).collect(), token_counts.truncate_to_budget(short, vocabulary, 3).collect(), strict=True):
        text = r.text or ""
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert p.prefix_tokens == want
        k = max(k for k, n in enumerate(want) if n <= 3)
        assert t.text == text[:k] and t.n_tokens == want[k]
