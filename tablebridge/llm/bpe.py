"""Exact byte-level BPE from a published vocabulary, without running merges.

Two encoders share one fact about BPE: a sequence of tokens is the encoding of its text exactly if
each token encodes to itself and each neighbouring pair does. Whether a pair does is found by undoing
the merges of its inner ends, latest first (:meth:`ByteBPE.fits`).

* :meth:`ByteBPE.prefix_table` is a dynamic programme over prefixes: every prefix has one last token.
* :meth:`ByteBPE.backtrack` takes longest matches and steps back where a pair doesn't fit;
  :meth:`ByteBPE.encode_arrays` does so for all new words of many texts at once, in array code.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import regex

#: The split pattern of byte-level tokenizers, and the visible bytes that stand for themselves.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VISIBLE = (range(33, 127), range(161, 173), range(174, 256))

#: Above this, a character's class may differ between Unicode versions: the library's own splitter decides.
_STABLE = "՗"
#: Cached words and pairs for each Python worker: bounds of memory, not of what is encoded.
CACHE_WORDS, CACHE_PAIRS = 300_000, 400_000
#: The longest match at a place is remembered by so many bytes from there, where they decide it.
NEAR = 6
#: Texts are encoded together up to so many characters, and words so many at a time; fewer than FEW, and pieces above LONG
#: characters, go one by one, so that the arrays stay small.
BATCH_CHARS, BATCH_WORDS, FEW, LONG = 1 << 18, 1 << 14, 32, 256
#: Slots of the pair table that array code looks pairs up in; what it doesn't hold is found and put there.
PAIR_SLOTS_LOG2 = 20


def _byte_of_char() -> dict[str, int]:
    plain = list(chain.from_iterable(VISIBLE))
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """A byte-level BPE vocabulary in the tokenizers library's JSON form."""

    def __init__(self, blob: bytes) -> None:
        spec = json.loads(blob)
        model, chars = spec["model"], _byte_of_char()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE without normaliser or prefix space is needed")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = model["vocab"]
        size = 1 + max([*vocab.values(), *self.special.values()])
        #: Token bytes as Latin-1 text, by id.
        self.tokens = [""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.tokens[i] = bytes(chars[c] for c in token).decode("latin-1")
        self.ids = {t: i for i, t in enumerate(self.tokens) if t}
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(size)), list(range(size))
        newest = -1
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b, ab = vocab[a], vocab[b], vocab[a + b]
            if ab <= newest:
                raise ValueError("ids must follow the order of merges")
            newest = ab
            self.merged[a, b] = ab
            self.left[ab], self.right[ab] = a, b
        self._fits: dict[int, bool] = {}
        self._first: dict[int, int] = {}
        self._near: dict[str, int] = {}
        # A token whose text other merges would take apart is in no encoding: the encoders must not know it.
        whole = self._whole()
        self.ids = {t: i for t, i in self.ids.items() if i in whole}
        self.sizes = [len(t) for t in self.tokens]
        self._most = max(self.sizes)
        self._shorter = [self._shorter_of(i) for i in range(size)]
        self.matcher = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.matcher.add_word(t, (i, len(t)))
        self.matcher.make_automaton()
        self._split = regex.compile(SPLIT)
        self._gap = regex.compile(r" (?=\s)")
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._blob, self._library = blob, None
        raw = [t.encode("latin-1") for t in self.tokens]
        for text, i in self.special.items():
            raw[i] = text.encode()
        #: The offset table: token i's bytes are flat[offsets[i] : offsets[i + 1]].
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in raw], out=self.offsets[1:])
        self.flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self._widths = np.diff(self.offsets)
        self._tables: _Tables | None = None
        self._decimals = np.array([f"{i}," for i in range(size)], dtype=bytes)
        self.counts, self._piece_counts = _Words(self._count), _Words(self._count_piece)
        #: Packed ids of words, and of the pieces that words with stops and line ends are made of.
        self.words = _Words(self._encode)

    # ---- pairs

    def fits(self, a: int, b: int) -> bool:
        """Whether a's text followed by b's text encodes to just (a, b)."""
        known = self._fits.get(a << 20 | b)
        if known is None:
            if len(self._fits) >= CACHE_PAIRS:
                self._fits.clear()
            known = self._fits[a << 20 | b] = self._check(a, b)
        return known

    def _whole(self) -> set[int]:
        """The tokens that encode to themselves: single bytes, and merges of two such whose border no earlier merge crosses."""
        out = {i for t, i in self.ids.items() if len(t) == 1}
        for (a, b), ab in self.merged.items():
            if a in out and b in out and self._check(a, b, ab):
                out.add(ab)
        return out

    def _check(self, a: int, b: int, bound: int | None = None) -> bool:
        # A merge across the border happens if its id is below those of the merges that made its ends
        # what they are. Undo the younger end first; what was undone last bounds the merges that count.
        bound = len(self.tokens) if bound is None else bound
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < bound:
                return False
            inner, outer = self.right[a], self.left[b]
            if a > b:
                if inner != a:
                    bound, a = a, inner
                elif outer != b:
                    bound, b = b + 1, outer
                else:
                    return True
            elif outer != b:
                bound, b = b + 1, outer
            elif inner != a:
                bound, a = a, inner
            else:
                return True

    # ---- prefix dynamic programming

    def prefix_table(self, piece: str) -> tuple[list[int], list[int]]:
        """(last token, number of tokens) of each non-empty prefix of a piece in Latin-1."""
        n = len(piece)
        last, count = [-1] * n, [0] * n
        fits, known = self.fits, self._fits.get
        for end, (token, size) in self.matcher.iter(piece):
            if count[end]:
                continue
            before = end - size
            if before < 0:
                last[end], count[end] = token, 1
            else:
                a = last[before]
                ok = known(a << 20 | token)
                if fits(a, token) if ok is None else ok:
                    last[end], count[end] = token, count[before] + 1
        return last, count

    # ---- backtracking

    def _shorter_of(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        text = self.tokens[token]
        for n in range(len(text) - 1, 0, -1):
            if (found := self.ids.get(text[:n], -1)) >= 0:
                return found
        return -1

    def _longest(self, piece: str, at: int) -> int:
        """The longest token that the piece has at a place."""
        rest = piece[at : at + self._most]
        path = self.matcher.longest_prefix(rest)
        for n in range(path, 0, -1):
            if (found := self.ids.get(rest[:n], -1)) >= 0:
                if path < NEAR:  # no token goes on, whatever follows these bytes
                    if len(self._near) >= CACHE_PAIRS:
                        self._near.clear()
                    self._near[rest[:NEAR]] = found
                return found
        raise ValueError("the vocabulary has no token for a byte")

    def _first_fit(self, last: int, token: int) -> int:
        """The token itself, or the longest of its prefixes, that fits after the last one (-1: none yet); -1 if none does."""
        found = token
        while last >= 0 and found >= 0 and not self.fits(last, found):
            found = self._shorter[found]
        return found

    def backtrack(self, piece: str) -> list[int]:
        """The tokens of a piece in Latin-1. Each position is given up once at most, so the time is linear."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        # This loop is most of the time of encoding: known matches and pairs are looked up here, without a call.
        near, first, sizes, shorter = self._near, self._first, self.sizes, self._shorter
        at, last, n = 0, -1, len(piece)
        out: list[int] = []
        closed: set[int] = set()
        while at < n:
            token = near.get(piece[at : at + NEAR])
            if token is None:
                token = self._longest(piece, at)
            while True:
                while token >= 0:
                    found = first.get(last << 20 | token)
                    if found is None:
                        if len(first) >= CACHE_PAIRS:
                            first.clear()
                        found = first[last << 20 | token] = self._first_fit(last, token)
                    token = found
                    if token < 0 or at + sizes[token] not in closed:
                        break
                    token = shorter[token]
                if token >= 0:
                    break
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
                token, last = shorter[token], out[-1] if out else -1
            out.append(token)
            at += sizes[token]
            last = token
        return out

    # ---- texts

    def split(self, text: str) -> list[str]:
        """The pieces that merges never cross."""
        if text and max(text) > _STABLE:
            if self._library is None:
                from tokenizers import Tokenizer

                self._library = Tokenizer.from_str(self._blob.decode()).pre_tokenizer
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return self._split.findall(text)

    def _words(self, text: str) -> list[str]:
        """The text cut before each space that a non-space follows; pieces never cross such a cut."""
        if "\0" in text or self._gap.search(text):
            return self.split(text)
        words = text.replace(" ", "\0 ").split("\0")
        return words if words[0] else words[1:]

    def _pieces(self, word: str) -> list[str]:
        """split(), with a short way for letters after at most one space and before at most one stop or comma."""
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha():
            if bare.isascii() or max(bare) <= _STABLE:
                return [word]
        elif bare[:-1].isalpha() and bare[-1] in ".," and (bare.isascii() or max(bare) <= _STABLE):
            return [word[:-1], word[-1]]
        return self.split(word)

    def _count(self, word: str) -> int:
        return sum(map(self._piece_counts.__getitem__, self._pieces(word)))

    def _count_piece(self, p: str) -> int:
        piece = p.encode().decode("latin-1")
        return 1 if piece in self.ids else self.prefix_table(piece)[1][-1]

    def _encode(self, word: str) -> bytes:
        pieces = self._pieces(word)
        if len(pieces) > 1:
            return b"".join(map(self.words.__getitem__, pieces))
        return array("i", self.backtrack(word if word.isascii() else word.encode().decode("latin-1"))).tobytes()

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """(plain text, None) and (special text, id) in order."""
        if not self._specials or not any(s in text for s in self.special):
            return [(text, None)] if text else []
        out, at = [], 0
        for m in self._specials.finditer(text):
            if m.start() > at:
                out.append((text[at : m.start()], None))
            out.append((m[0], self.special[m[0]]))
            at = m.end()
        return [*out, (text[at:], None)] if at < len(text) else out

    def count(self, text: str | None) -> int:
        """The number of tokens, from the last entries of the words' prefix tables."""
        total = 0
        for part, special in self.parts(text or ""):
            total += 1 if special is not None else sum(map(self.counts.__getitem__, self._words(part)))
        self.counts.trim(CACHE_WORDS)
        self._piece_counts.trim(CACHE_WORDS // 2)
        return total

    def encode(self, text: str | None) -> list[int]:
        return self.encode_array(text).tolist()

    def encode_array(self, text: str | None) -> np.ndarray:
        return next(self.encode_arrays([text]))

    def encode_arrays(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """encode() of each text. Words that aren't known are encoded together, for as many texts as BATCH_CHARS has room for."""
        batch, chars = [], 0
        for text in texts:
            batch.append(text or "")
            chars += len(batch[-1])
            if chars >= BATCH_CHARS:
                yield from self._encode_batch(batch)
                batch, chars = [], 0
        yield from self._encode_batch(batch)

    def _encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        self.words.trim(CACHE_WORDS)
        cut = [[(self._words(part), special) for part, special in self.parts(t)] for t in texts]
        self._learn(set().union(*(ws for parts in cut for ws, special in parts if special is None)))
        for parts in cut:
            out: list[bytes] = []
            for ws, special in parts:
                if special is None:
                    out.extend(map(self.words.__getitem__, ws))
                else:
                    out.append(array("i", [special]).tobytes())
            yield np.frombuffer(b"".join(out), dtype=np.intc)

    def _learn(self, words: set[str]) -> None:
        """Encode the words that aren't known yet; what is left out here is encoded when it is looked up."""
        known, old = self.words, self.words.old
        single: list[str] = []
        several: list[str] = []  # words of more than one piece; their pieces are kept flat, as many small lists are slow to collect
        counts: list[int] = []
        flat: list[str] = []
        for w in words:
            if w not in known and w not in old:
                ps = self._pieces(w)
                if len(ps) == 1:
                    single.append(w)
                else:
                    several.append(w)
                    counts.append(len(ps))
                    flat.extend(ps)
        single.extend({p for p in flat if p not in known and p not in old}.difference(single))
        single = [p for p in single if len(p) <= LONG]
        if len(single) < FEW:
            return
        for at in range(0, len(single), BATCH_WORDS):
            some = single[at : at + BATCH_WORDS]
            known.update(zip(some, self._backtrack_all(some), strict=True))
        rest = iter(flat)
        for w, n in zip(several, counts, strict=True):
            known[w] = b"".join(map(known.__getitem__, islice(rest, n)))

    def _backtrack_all(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece: backtrack() for all pieces at once, each round tries one token of each."""
        if self._tables is None:
            self._tables = _Tables(self)
        tab, sizes, shorter = self._tables, self._tables.sizes, self._tables.shorter
        raw = [p.encode() for p in pieces]
        buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        token_at = np.zeros(len(buf), dtype=np.intc)  # of each token taken, by its start
        before = np.zeros(len(buf) + 1, dtype=np.int64)  # its start, by its end
        taken, closed = np.zeros(len(buf), dtype=bool), np.zeros(len(buf) + 1, dtype=bool)
        none = len(self.tokens)
        which, at, last = np.arange(len(raw)), starts, np.full(len(raw), none, dtype=np.int64)
        token = tab.longest(buf, at, ends)
        while len(which) >= FEW:
            token = tab.first_fit(last, token)
            while len(shut := np.flatnonzero((token >= 0) & closed[at + sizes[token]])):
                token[shut] = tab.first_fit(last[shut], shorter[token[shut]])
            ok = token >= 0
            a, t = at[ok], token[ok]
            token_at[a], taken[a] = t, True
            e = a + sizes[t]
            before[e] = a
            go = e < ends[which[ok]]
            # Nothing fits: give the place up, and shorten the token before it.
            bad = ~ok
            a = at[bad]
            closed[a] = True
            a = before[a]
            taken[a] = False
            w, gone = which[bad], token_at[a]
            l = np.where(a > starts[w], token_at[before[a]], none)
            which, at, last = np.concatenate([which[ok][go], w]), np.concatenate([e[go], a]), np.concatenate([t[go], l])
            n = len(which) - len(w)
            token = np.concatenate([tab.longest(buf, at[:n], ends[which[:n]]), shorter[gone]])
        for w in which:  # what is left are few long pieces
            taken[starts[w] : ends[w]] = False
            place = starts[w]
            for t in self.backtrack(raw[w].decode("latin-1")):
                token_at[place], taken[place] = t, True
                place += sizes[t]
        packed = token_at[taken].tobytes()
        bounds = (np.concatenate([[0], np.cumsum(taken)])[np.concatenate([starts[:1], ends])] * token_at.itemsize).tolist()
        return [packed[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self._decimals[ids].tobytes().translate(None, b"\0")[:-1]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, gathered from the offset table."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return b""
        starts, sizes = self.offsets[ids], self._widths[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """For each k from 0 to len(text), the exact number of tokens of text[:k].

        Within a piece these are its prefix table's entries. A prefix that ends in white space holds
        that run as one piece; one that ends in a contraction or a special string is split anew.
        """
        text = text or ""
        out = np.zeros(len(text) + 1, dtype=np.int32)
        base, at = 0, 0
        for part, special in self.parts(text):
            if special is not None:
                lead = part[:0]
                begin = at
                while begin and not any(text.startswith(s, begin - len(s)) for s in self.special if begin >= len(s)):
                    begin -= 1  # the plain text since the last special string
                lead, before = text[begin:at], int(out[begin])
                for k in range(1, len(part)):
                    out[at + k] = before + sum(self._count(w) for w in self.split(lead + part[:k]))
                base += 1
                out[at + len(part)] = base
            else:
                for p in self.split(part):
                    base = self._fill(out, text, at, p, base)
                    at += len(p)
                self._fill_spaces(out, part, at - len(part))
                continue
            at += len(part)
        return out

    def _at_chars(self, piece: str) -> list[int]:
        """Prefix counts at character ends."""
        _, count = self.prefix_table(piece.encode().decode("latin-1"))
        ends = np.cumsum([len(c.encode()) for c in piece]) - 1
        return [count[e] for e in ends]

    def _fill(self, out: np.ndarray, text: str, at: int, piece: str, base: int) -> int:
        counts = self._at_chars(piece)
        for k, c in enumerate(counts, 1):
            partial = piece[:k]
            if k < len(piece) and piece[0] == "'" and piece[1].isalpha():
                c = sum(self._count(w) for w in self.split(partial))
            out[at + k] = base + c
        return base + counts[-1]

    def _fill_spaces(self, out: np.ndarray, part: str, begin: int) -> None:
        for m in regex.finditer(r"\s+", part):
            for k, c in enumerate(self._at_chars(m[0]), 1):
                out[begin + m.start() + k] = out[begin + m.start()] + c


def _slots(key: np.ndarray, bits: int) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class _Tables:
    """A vocabulary's trie, prefixes and pairs as arrays."""

    def __init__(self, coder: ByteBPE) -> None:
        self.coder = coder
        # One more entry for no token (-1).
        self.sizes = np.array([*coder.sizes, 0], dtype=np.int64)
        self.shorter = np.array([*coder._shorter, -1], dtype=np.int64)
        number = {"": 0}
        inner = dict.fromkeys(t[:n] for t in coder.ids for n in range(1, len(t)))
        for p in chain(inner, coder.ids):
            number.setdefault(p, len(number))
        #: Nodes below this go on. Edges are hashed by node and byte, as all bytes of all nodes would take ten times the memory.
        self.inner = len(inner) + 1
        edges = np.fromiter((number[p[:-1]] << 8 | ord(p[-1]) for p in number if p), dtype=np.int64, count=len(number) - 1)
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.edges, self.nodes = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(edges)), _slots(edges, self.bits)
        while len(left):
            free = self.edges[slot] < 0
            self.edges[slot[free]] = edges[left[free]]
            mine = self.edges[slot] == edges[left]
            self.nodes[slot[mine]] = left[mine] + 1
            left, slot = left[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)
        #: The longest token that is the node's text or a prefix of it.
        self.best = np.full(len(number), -1, dtype=np.int64)
        for p, i in sorted(number.items(), key=lambda x: len(x[0])):
            self.best[i] = coder.ids.get(p, self.best[number[p[:-1]]] if p else -1)
        slots = 1 << PAIR_SLOTS_LOG2
        self.keys, self.fit = np.full(slots, -1, dtype=np.int64), np.zeros(slots, dtype=np.int32)

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node that each byte leads to, or -1."""
        key = node.astype(np.int64) << 8 | byte
        slot = _slots(key, self.bits)
        out, found = self.nodes[slot], self.edges[slot]
        late = np.flatnonzero((found != key) & (found >= 0))
        out[found < 0] = -1
        while len(late):
            slot[late] = (slot[late] + 1) & ((1 << self.bits) - 1)
            found = self.edges[slot[late]]
            out[late] = np.where(found == key[late], self.nodes[slot[late]], -1)
            late = late[(found != key[late]) & (found >= 0)]
        return out

    def longest(self, buf: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest token at each place."""
        node = self.child(np.zeros(len(at), dtype=np.int64), buf[at])
        if len(node) and node.min() < 0:
            raise ValueError("the vocabulary has no token for a byte")
        out, which, depth = self.best[node], np.arange(len(at)), 1
        while True:
            on = np.flatnonzero((node < self.inner) & (at + depth < ends))
            node, which, at, ends = node[on], which[on], at[on], ends[on]
            node = self.child(node, buf[at + depth])
            on = np.flatnonzero(node >= 0)
            if not len(on):
                return out
            node, which, at, ends = node[on], which[on], at[on], ends[on]
            out[which] = self.best[node]
            depth += 1

    def first_fit(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """ByteBPE._first_fit() of each pair; -1 for no token."""
        key = last << 20 | token
        slot = _slots(key, PAIR_SLOTS_LOG2)
        out = self.fit[slot].astype(np.int64)
        new = (self.keys[slot] != key) & (token >= 0)
        if new.any():
            for k, s in set(zip(key[new].tolist(), slot[new].tolist(), strict=True)):
                a, t = k >> 20, k & 0xFFFFF
                self.keys[s], self.fit[s] = k, self.coder._first_fit(a if a < len(self.coder.tokens) else -1, t)
            late = np.flatnonzero(new)
            out[late] = self.fit[slot[late]]
            for i in late[self.keys[slot[late]] != key[late]]:  # two of these share a slot
                a = int(last[i])
                out[i] = self.coder._first_fit(a if a < len(self.coder.tokens) else -1, int(token[i]))
        out[token < 0] = -1
        return out


class _Words(dict):
    """A bounded cache that fills itself: what is full becomes the old half, from which words in use come back."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self, most: int) -> None:
        if len(self) > most // 2:
            self.old = dict(self)
            self.clear()


_LOADED: dict[str, ByteBPE] = {}


def load(blob: bytes) -> ByteBPE:
    """The vocabulary, built once for each Python process."""
    key = hashlib.sha1(blob).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(blob)
    return _LOADED[key]
