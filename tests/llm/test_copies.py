"""Near duplicates, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tablebridge.llm import decontam, minhash, substrings
from tablebridge.llm.common import components, id_bitmap, split_by_bitmap, windows, word_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def shingle_set(text, k):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if len(w) >= k else frozenset([tuple(w)])


def brute_components(rows, k, percent=80):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingle_set(t, k))
    ids, up = sorted(sets), {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def corpus():
    """Copies, chains of near copies, a large near group with outliers, short texts."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    rows, n = [], 0

    def add(w):
        nonlocal n
        rows.append((n, " ".join(w)))
        n += 1

    for _ in range(25):
        base = text(r.randrange(1, 80))
        add(base)
        for _ in range(r.randrange(3)):
            copy = list(base)
            for _ in range(r.randrange(1 + len(copy) // 12)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            add(copy)
    base = text(120)
    for _ in range(90):
        copy = list(base)
        for _ in range(r.choice([0, 1, 2, 4, 6, 8, 12, 20])):
            copy[r.randrange(120)] = r.choice(vocabulary)
        add(copy)
    chain = text(100)
    for i in range(12):
        chain = chain[6:] + text(6)
        add(chain)
    return rows


@pytest.mark.parametrize(("k", "block", "hubs"), [(2, 1000, 8), (5, 1000, 8), (2, 12, 2), (2, 7, 1)])
def test_components_like_brute_force(spark, corpus, k, block, hubs):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df, minhash.Settings(words=k, block=block, hubs=hubs)).collect()}
    want = brute_components(corpus, k)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingle_set(t, k)) and got[i].kept == (want[i] == i) for i, t in corpus)


def test_estimate_is_close_to_jaccard():
    s, r = minhash.Settings(words=1), random.Random(3)
    a, errors = s.multipliers(), []
    for share in (0.2, 0.5, 0.8, 0.9):
        for _ in range(8):
            pool = [f"{r.random()}" for _ in range(600)]
            n = int(400 * share)
            x, y = pool[:400], pool[400 - n : 800 - n]
            sets = [minhash.shingles(" ".join(t), 1) for t in (x, y)]
            sigs = minhash.unpack([minhash.pack(minhash.minima(v, a), s.bits, s.offsets()) for v in sets], s)
            errors.append(minhash.similarity(sigs[0], sigs[1:], s)[0] - len(set(x) & set(y)) / len(set(x) | set(y)))
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


@pytest.mark.parametrize(("size", "shared", "pairs"), [(5, 4, 1_000_000), (10, 8, 50_000)])
def test_no_pair_at_the_threshold_is_dropped(size, shared, pairs):
    """Sets that share 4 of 5 shingles: the estimate lets them pass, and they share a band."""
    s, rng, dropped, apart = minhash.Settings(words=2), np.random.default_rng(9), 0, 0
    a, offsets = s.multipliers(), s.offsets()
    for _ in range(0, pairs, 1000):
        x = rng.integers(0, 1 << 32, (1000, size), dtype=np.uint64).astype(np.uint32)
        m = x[:, :, None] * a
        one, two = m.min(axis=1), m[:, :shared].min(axis=1)
        agree = (minhash.low_bits(one, s.bits, offsets) == minhash.low_bits(two, s.bits, offsets)).mean(axis=1)
        dropped += int(((agree - 0.25) / 0.75 < s.percent / 100 - s.slack).sum())
        apart += int((~(one == two).reshape(1000, s.bands, s.rows).all(axis=2).any(axis=1)).sum())
    assert dropped == 0 and apart <= 2


def test_odd_near_duplicates(odd, empty):
    got = minhash.near_duplicates(odd, minhash.Settings(words=2)).collect()
    assert len(got) == odd.count()
    want = brute_components([(r.doc_id, r.text) for r in odd.collect()], 2)
    assert all(r.kept and r.component_id is None if r.doc_id is None else r.component_id == want[r.doc_id] for r in got)
    assert {r.n_shingles for r in got if r.doc_id in (1, 2, 3)} == {0}
    left = minhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted([r.doc_id for r in left.collect()], key=repr) == sorted([1, 2, 3, 4, None, 5, 6, 7, 8], key=repr)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.drop_near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_components_of_long_paths(spark):
    r = random.Random(8)
    names = r.sample(range(10**4, 10**6), 300)
    edges = [(i, i + 1) for i in range(2000, 2400)] + list(zip(names, names[1:], strict=False))
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 2000 for i in range(2000, 2401)} | {i: min(names) for i in names}


def test_bitmaps_never_miss(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    hit, clean = split_by_bitmap(df, "k", id_bitmap(df.where("k % 7 = 0"), "k", 1 << 15), 1 << 15)
    assert {r.k for r in hit.collect()} >= set(range(0, 500, 7)) and hit.count() + clean.count() == 500 and clean.count() > 350


def test_windows_are_equal_where_words_are():
    h = word_hashes([b"a", b"b", b"a", b"b", b"a", b"b", b"a"])
    for n in (1, 2, 3, 5, 7):
        w = windows(h, n)
        assert len(w) == 8 - n and all((w[i] == w[j]) == (h[i : i + n].tolist() == h[j : j + n].tolist()) for i in range(len(w)) for j in range(len(w)))
    assert len(windows(h, 8)) == 0


# ---- repeated passages


def brute_repeats(rows, n):
    first, out = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for p in range(len(w) - n + 1):
            first.setdefault(tuple(w[p : p + n]), i)
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - n + 1):
                if first[tuple(w[p : p + n])] < i:
                    gone[p : p + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("n", "start"), [(1, 16), (2, 16), (7, 16), (10, 3), (7, 1)])
def test_passages_like_brute_force(spark, n, start):
    r = random.Random(n)
    vocabulary = [f"v{i}" for i in range(60)]
    passages = [[r.choice(vocabulary) for _ in range(r.randrange(5, 30))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = [r.choice(vocabulary) for _ in range(r.randrange(30))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(passages)
        rows.append((i * 3 % 61, " ".join(w)))
    rows += [(500, rows[0][1]), (501, "x " * 40), (502, "x " * 25), (503, None), (None, rows[1][1]), (504, "y " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(df, n, start=start)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, n)
    digests = {r.doc_id: r.kept_sha256 for r in substrings.remove_repeats(df, n, digest=True, start=start).collect() if r.doc_id is not None}
    assert all(digests[i] == hashlib.sha256(t.encode()).hexdigest() for i, _, _, t in brute_repeats(rows, n) if i is not None)


def test_odd_passages(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, substrings.remove_repeats(odd, 5).collect()), key=repr) == brute_repeats(rows, 5)
    assert substrings.remove_repeats(empty, 5).count() == 0 and substrings.repeat_levels(empty, 5).count() == 0


def test_ladder():
    assert substrings.ladder(50) == [13, 25, 50] and substrings.ladder(1) == [1, 1] and substrings.ladder(7, 1) == [1, 2, 4, 7] and substrings.ladder(10) == [5, 10]


def test_levels_end(spark, monkeypatch):
    base = [f"u{i}" for i in range(50)]
    read, windows_of = [], substrings.repeated_windows
    monkeypatch.setattr(substrings, "repeated_windows", lambda rows, n, start: read.append(rows.count()) or windows_of(rows, n, start))
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:25] + ["z"])), (3, " ".join(["q"] + base[5:12])), (4, "nothing here")], "doc_id long, text string")
    assert {r.doc_id: r.words for r in substrings.repeat_levels(df, 5).collect()} == {2: 20, 3: 5}
    assert read == [4, 3, 2, 2]  # at 5, 10, 20 and 40 words


def test_shorter_levels_read_less(spark, monkeypatch):
    """Documents whose passages end before the next length take no part in it."""
    r = random.Random(1)
    text = lambda n: [f"z{r.randrange(10**7)}" for _ in range(n)]
    shared = [text(n) for n in (15, 30, 60)]
    rows = [(10 * k + j, " ".join(text(40) + shared[k] + text(40))) for k in range(3) for j in range(4)] + [(100 + j, " ".join(text(90))) for j in range(8)]
    df, seen, hits = spark.createDataFrame(rows, "doc_id long, text string"), [], substrings._hits
    monkeypatch.setattr(substrings, "_hits", lambda found: seen.append(found.count()) or hits(found))
    got = {x.doc_id: x.n_removed for x in substrings.remove_repeats(df, 50, start=7).collect()}
    assert {i: n for i, n in got.items() if n} == {21: 60, 22: 60, 23: 60}
    assert seen == [20, 8, 4]  # documents compared by windows of 7, 13 and 25 words


# ---- leaks


def brute_tiles(p, t, least):
    mp, mt, out = [False] * len(p), [False] * len(t), []
    while True:
        best, found = least - 1, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if best < least:
            return out
        for i, j in found:
            if not any(mp[i : i + best]) and not any(mt[j : j + best]):
                mp[i : i + best] = [True] * best
                mt[j : j + best] = [True] * best
                out.append((i, j, best))


def test_tiles_like_brute_force():
    r = random.Random(2)
    for _ in range(150):
        p, t = ([r.choice("abcd") for _ in range(r.randrange(1, 22))] for _ in range(2))
        h = [word_hashes([c.encode() for c in x]) for x in (p, t)]
        assert decontam.tiles(*h, 2) == brute_tiles(p, t, 2)


def test_leaks(spark, odd, empty):
    r = random.Random(4)
    item = [f"t{i}" for i in range(30)]
    filler = lambda n: [f"f{r.randrange(10**6)}" for _ in range(n)]
    docs = [
        (1, " ".join(filler(20) + item + filler(20))),
        (2, " ".join(filler(5) + item[20:] + filler(9) + item[10:20] + filler(7) + item[:10])),  # in another order
        (3, " ".join(filler(5) + item[:20])),  # two thirds of it
        (4, " ".join(w.upper() + "," for w in item)),
        (5, " ".join(filler(50))),
        (5, " ".join(filler(50))),
        (None, " ".join(item)),
        (6, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (4, " ".join(item))], "item_id long, text string")
    found = decontam.contamination(df, benchmark).collect()
    assert {(x.doc_id, x.item_id): x.n_covered for x in found} == {(d, i): n for d, n in ((1, 30), (2, 30), (3, 20), (4, 30)) for i in (1, 4)}
    assert {x.doc_id for x in decontam.leaks(df, benchmark).collect()} == {1, 2, 4}
    assert sorted([x.doc_id for x in decontam.remove_leaks(df, benchmark).collect()], key=repr) == sorted([3, 5, 5, 6, None], key=repr)
    assert decontam.leaks(odd, benchmark).count() == 0 and decontam.leaks(empty, benchmark).count() == 0
    assert decontam.remove_leaks(odd, benchmark.where("false")).count() == odd.count()


def brute_leaks(docs, items, threshold, least=5):
    cut = lambda t: re.sub(r"[^0-9a-z]", " ", (t or "").lower()).split()
    out = set()
    for d, t in docs:
        for i, p in items:
            p, m = cut(p), min(least, len(cut(p)))
            if d is not None and p and sum(x[2] for x in brute_tiles(p, cut(t), m)) >= max(1, threshold * len(p)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("common", [1, 8])
def test_leaks_like_brute_force(spark, common):
    """A run that all documents and items share, items of one to four tokens, cut up and reordered passages."""
    r = random.Random(12)
    fill = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    shared = [f"s{i}" for i in range(9)]
    items = [shared + fill(r.randrange(6, 30)) for _ in range(24)] + [fill(n) for n in (1, 2, 3, 4)]
    docs = []
    for k in range(70):
        w = fill(r.randrange(12)) + shared
        if k % 3:
            p = list(r.choice(items))
            p = p[: r.randrange(1 + len(p) // 2, 1 + len(p))]
            at = r.randrange(len(p))
            w += r.choice([p, p[at:] + fill(2) + p[:at]]) + fill(r.randrange(5))
        if k % 5 == 0:
            w += items[24 + k % 4]
        docs.append((k, " ".join(w)))
    items = [(i, " ".join(w)) for i, w in enumerate(items)]
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), common=common, bits=1 << 15).collect()
    want = brute_leaks(docs, items, 0.8)
    assert {(x.doc_id, x.item_id) for x in got} == want and any(i >= 24 for _, i in want) and len(want) > 10


def test_common_seeds_join_no_pairs(spark):
    """Documents that share a run with all items, and no more, are dropped before any text moves."""
    shared = " ".join(f"s{i}" for i in range(6))
    docs = spark.range(200).selectExpr("id", f"concat('{shared} d', id) as text")
    items = spark.range(40).selectExpr("id", f"concat('{shared}', array_join(transform(sequence(1, 40), x -> concat(' i', id, 'x', x)), '')) as text")
    wanted = decontam._needed(decontam._item_seeds(items, 5), 0.8, 8)
    assert wanted.join(decontam._item_seeds(docs.where("id = 0"), 5).select("seed"), "seed").count() == 0
    assert decontam._candidates(docs, items, 0.8, 5, 8, None).count() == 0
