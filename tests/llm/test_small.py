"""Helpers of the training-data operators, without Spark."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stackyard.llm import decontaminate, fm_index, idfiles, packing, quality, segments, simhash, suffix_array, suffix_model
from stackyard.llm.tokens import PieceEncoder
from stackyard.llm.words import Texts

ODD = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", "'s", "¶", "é", "e", "́", "7", "!!", "Σ",
       "日本", "\x00", "\r\n", "😀", ". ", ", ", ".\n", "é, ", "”. ", "×, ", "<|endoftext|>", "word"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder_equals_library(name):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    enc = PieceEncoder(public_tokenizers.path(name))
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # new pieces, then cached ones
        got = enc.encode([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 24, 32])
def test_packed_ids_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000, 70_000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = idfiles.pack(ids, bits)
        assert len(data) == (n * bits + 7) // 8
        assert (idfiles.unpack(data, bits, 0, n) == ids).all()
        if n > 20:
            assert (idfiles.unpack(data, bits, 13, n - 15) == ids[13:n - 2]).all()
    with pytest.raises(ValueError):
        idfiles.pack(np.array([8], np.uint32), 3)


def test_width_is_the_fewest_bits():
    assert [idfiles.width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def best_possible(lengths, cap):
    """Fewest bins by search."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1:]])
        go(i + 1, [*rooms, cap - lengths[i]])

    go(0, [])
    return best


def test_plan_holds_all_pieces_and_stays_near_the_optimum():
    rng = random.Random(2)
    excess = 0
    for _ in range(150):
        cap = rng.randint(4, 30)
        lengths = sorted((rng.randint(1, cap) for _ in range(rng.randint(0, 9))), reverse=True)
        runs = packing.plan_packing(Counter(lengths), cap)
        assert Counter(w for n, ws in runs for w in ws * n) == Counter(lengths)
        assert all(sum(ws) <= cap for _, ws in runs)
        excess += sum(n for n, _ in runs) - best_possible(lengths, cap)
    assert excess <= 3


def test_dominance_fixes_only_optimal_sets():
    rng = random.Random(4)
    for _ in range(200):
        cap = rng.randint(4, 24)
        lengths = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = [0] * (cap + 1)
        for w in lengths:
            counts[w] += 1
        fixed = packing._fix_dominant(counts, cap)
        rest = sorted((w for w in range(cap + 1) for _ in range(counts[w])), reverse=True)
        assert sum(n for n, _ in fixed) + best_possible(rest, cap) == best_possible(lengths, cap)


def test_places_tile_the_sequences():
    counts = Counter({3: 50, 5: 21, 2: 7, 10: 4})
    runs = packing.plan_packing(counts, 10)
    table = packing.place_table(runs)
    used = Counter()
    for w, n in counts.items():
        first, base, offset = table[w]
        for r in range(n):
            i = np.searchsorted(first, r, side="right") - 1
            for k in range(w):
                used[(base[i] + r - first[i], offset[i] + k)] += 1
    assert max(used.values()) == 1
    assert all((s, o - 1) in used for s, o in used if o)


def test_plan_rejects_lengths_out_of_range():
    with pytest.raises(ValueError):
        packing.plan_packing({11: 1}, 10)


def repeats(bodies, copies, k):
    c = Counter()
    for b, m in zip(bodies, copies):
        for i in range(len(b) - k + 1):
            c[b[i:i + k]] += m
    return [[c[b[i:i + k]] > 1 for i in range(len(b) - k + 1)] for b in bodies]


def test_suffix_array_and_repeated_windows():
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", b"abc\0\xff", bytes(range(256))])
        k = rng.choice([1, 2, 5, 9])
        base = bytes(rng.choice(letters) for _ in range(60))
        bodies = [base[i:i + rng.randint(k, 40 + k)] + bytes(rng.choice(letters) for _ in range(k))
                  for i in (rng.randint(0, 50) for _ in range(rng.randint(1, 6)))]
        t = np.concatenate([np.frombuffer(b, np.uint8).astype(np.int64) + 2 for b in bodies] + [np.zeros(1, np.int64)])
        sa = suffix_array.suffix_array(t, 258)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        copies = np.array([rng.choice([1, 1, 2]) for _ in bodies])
        got = suffix_array.repeated_windows(bodies, copies, k)
        assert [g.tolist() for g in got] == repeats(bodies, copies, k)


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 300):
        v = rng.integers(0, size, 500)
        w = fm_index.WaveletMatrix(v, size)
        c, i = rng.integers(0, size, 200), rng.integers(0, 501, 200)
        assert w.rank(c, i).tolist() == [int((v[:b] == a).sum()) for a, b in zip(c, i)]


def test_earlier_windows_against_all_pairs():
    rng = np.random.default_rng(6)
    for size in (2, 3, 50):
        for k in (1, 3, 6):
            bodies = [rng.integers(0, size, rng.integers(k, 40)).astype(np.uint64) for _ in range(6)]
            place = np.array([[d, 0, s] for d, s in zip((4, 1, 1, 9, 2, 2), (0, 50, 0, 7, 0, 300))], np.int64)
            got = fm_index.earlier_windows(bodies, place, k)
            first = {}
            for b, p in zip(bodies, place.tolist()):
                for i in range(len(b) - k + 1):
                    w, at = tuple(b[i:i + k]), (p[0], p[1], p[2] + i)
                    first[w] = min(first.get(w, at), at)
            for b, p, g in zip(bodies, place.tolist(), got):
                assert g.tolist() == [(p[0], p[1], p[2] + i) > first[tuple(b[i:i + k])] for i in range(len(b) - k + 1)]


def test_segments_give_equal_windows_one_key():
    rng = np.random.default_rng(8)
    for letters in (1, 2, 40):
        grams = rng.integers(0, letters, 400).astype(np.uint64)
        w = 7
        valid = np.ones(len(grams) - w + 1, bool)
        valid[100:100 + w] = False
        start, n, key, places = segments.find_segments(grams, w, valid)
        covered = np.zeros(len(valid), int)
        for s, m, k, c in zip(start, n, key, places):
            covered[s:s + m] += 1
            assert all(grams[i:i + w].min() == k for i in range(s, s + m))
            assert c >= (grams[s:s + m + w - 1] == k).sum()
        assert (covered == valid).all()


def test_long_runs_are_cut():
    grams = np.zeros(10_000, np.uint64)
    start, n, _, _ = segments.find_segments(grams, 5, np.ones(9_996, bool))
    assert n.sum() == 9_996 and n.max() == segments.MAX_RUN and (np.diff(start) == n[:-1]).all()


def test_links_of_a_shard_connect_all_close_pairs():
    rng = np.random.default_rng(9)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, 3)).astype(np.uint64), axis=1)
                                   for c in centre] + [rng.integers(0, 1 << 63, 3000, dtype=np.uint64)]))
    want = simhash._Forest(len(fp))
    x, y = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2)
    want.link(x, y)
    child, root = simhash.link_shard(fp, 2)
    got = simhash._Forest(len(fp))
    got.link(child, root)
    assert (got.root == want.root).all()
    # the same over a tree's shards
    tree = simhash.fit_tree(fp[::3], 16, 2)
    rows, leaf = simhash.route(tree, fp, 2)
    assert set(rows.tolist()) == set(range(len(fp))) and leaf.max() >= 3
    got = simhash._Forest(len(fp))
    for k in np.unique(leaf):
        own = rows[leaf == k]
        child, root = simhash.link_shard(fp[own], 2)
        got.link(own[child], own[root])
    assert (got.root == want.root).all()


def test_js_distance():
    p = np.array([1.0, 1.0, 0.0])
    assert quality.js_distance(p, 7 * p) == pytest.approx(0)
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    assert quality.js_distance(np.zeros(2), p[:2]) == 0


def test_grams_of_pieces(monkeypatch):
    text = b"abc ab cab"
    whole, size = suffix_model._grams([b"\n\n" + text + b"\n"], 2)
    past = b"\n\n" + text + b"\n"
    assert size.tolist() == [11]
    assert whole.tolist() == [past[i - 1] << 16 | past[i - 2] << 8 | past[i] for i in range(2, len(past))]
    monkeypatch.setattr(suffix_model, "BLOCK", 4)  # a text in pieces has the same grams
    cut = [(of, suffix_model._grams(p, 2)) for of, p in suffix_model._blocks([text, b"", b"x"], 2)]
    assert len(cut) > 3 and [i for of, _ in cut for i in of] == [0, 0, 0, 1, 2]
    assert np.concatenate([g for _, (g, _) in cut]).tolist()[:11] == whole.tolist()
    assert sum(int(n.sum()) for _, (_, n) in cut) == 11 + 1 + 2


def test_fingerprints_by_definition():
    import xxhash

    texts = [b"", b" \t ", b"One", b"one TWO", b"a b c d e f a b c", b"a  b\tc\nd", "É é É".encode()]
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    for t, got in zip(texts, simhash.fingerprints(texts).tolist()):
        w = t.translate(lower).split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        assert got == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_texts_split_words_at_ascii_space_only():
    texts = [b"", b"  a b ", "x\xa0y\x85z".encode(), b"\x0b\x0c", b"one\r\ntwo\x1cthree"]
    t = Texts(texts)
    assert t.n_words.tolist() == [len(x.split()) for x in texts]
    h = t.hashes()
    assert len(set(h.tolist())) == len(h)


def test_item_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, 6).astype(np.uint8)) for _ in range(400)]
    items = [b" ".join(words[j] for j in rng.integers(0, 400, 12)) for _ in range(60)]
    index = decontaminate.ItemIndex(list(range(60)), items, 5, 0.8, 18)
    for fp in rng.integers(0, 1 << 63, 50, dtype=np.uint64).tolist() + index.fp.tolist():
        fp = np.uint64(fp)
        want = np.flatnonzero(np.bitwise_count(index.fp ^ fp) <= 18).tolist()
        assert index.within(fp, 12) == want
        assert index.within(fp, 11) == []
