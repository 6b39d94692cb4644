import random
import re
from itertools import combinations

import numpy as np
import xxhash

from textloom.llm import simhash
from textloom.llm.common import materialize
from textloom.llm.components import components
from textloom.llm.queries import op4_simhash_near_dedup


def _print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(prints, bits=3):
    """Brute force: position -> smallest position reachable."""
    label = list(range(len(prints)))
    changed = True
    pairs = [(i, j) for i, j in combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= bits]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def test_fingerprint_by_definition():
    for text in (None, "", " \t", "One", "One TWO", "a b c", "A b\x0bc d e ÄÖ f " * 30, "x y z " * 70_000):
        assert simhash.fingerprint(text) == _print(text)


def test_index_sets_cover_every_shared_five():
    for size, n in ((3, 8), (4, 24), (5, 56)):
        sets = simhash.index_sets(size)
        assert len(sets) <= n and all(any(set(s) <= set(five) for s in sets) for five in combinations(range(8), 5))
    assert [simhash.index_size(n) for n in (10, 10**8, 10**9, 10**12)] == [3, 3, 4, 5]


def _random_prints(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 8)]
    out = set(base)
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
        base.append(x)
    return sorted(out)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_against_brute_force(spark):
    rng = random.Random(3)
    prints = _random_prints(rng, 400)
    want = _classes(prints)
    df = spark.createDataFrame([(_signed(p),) for p in prints], "fp bigint")
    for size, list_rows in ((3, 4096), (4, 4096), (5, 4096), (3, 3)):
        got = {r.node: r.root for r in components(simhash.links(df, size, list_rows)).collect()}
        groups = {}
        for p, w in zip(prints, want, strict=True):
            groups.setdefault(w, set()).add(got.get(_signed(p), _signed(p)))
        assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_tally_is_what_the_postings_hold():
    rng = random.Random(8)
    fps = np.array([sum(rng.choice((0, 1, 255)) << 8 * p for p in range(8)) for _ in range(300)], np.uint64)
    own = fps.view(np.uint8).reshape(-1, 8)
    same = (own[:, None, :] == own[None, :, :]).sum(-1)
    assert (simhash.Postings(fps).tally(np.arange(40, 90)) == same[40:90]).all()
    agree = fps & np.uint64(0xFFFFFF0000FFFFFF) | np.uint64(0x1234 << 24)
    assert (simhash.Postings(agree, (3, 4)).tally(np.arange(300)) == simhash.Postings(agree).tally(np.arange(300))).all()


def test_a_pair_below_the_least_tally_is_never_verified(monkeypatch):
    a = np.uint64(0x0101010101010101)
    fps = np.sort(np.array([a, a ^ np.uint64(0b111), a ^ np.uint64(0x0000000101010101), a ^ np.uint64(0x010101)], np.uint64))
    seen = []
    monkeypatch.setattr(simhash.np, "bitwise_count", lambda x, own=np.bitwise_count: (seen.append(len(x)), own(x))[1])
    rows, members = simhash.Postings(fps).linked(np.arange(4))
    tally = simhash.Postings(fps).tally(np.arange(4))
    assert seen == [int((tally >= 5).sum())] and seen[0] < 16
    assert {(int(i), int(j)) for i, j in zip(rows, members, strict=True)} == {(i, j) for i in range(4) for j in range(4) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}


def test_forest_by_neighbours_agrees():
    rng = random.Random(4)
    base = rng.getrandbits(64) & ~0xFFFFFF
    fps = np.sort(np.array(sorted({base | rng.getrandbits(24) & 0xF3F1C7 for _ in range(600)}), np.uint64))
    a, b = simhash.forest(fps), simhash.forest_by_neighbours(fps, (3, 4, 5, 6, 7))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_components_of_chains_stars_and_repeats(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 300)] + [(300, 299), (300, 299), (7, 7), (-5, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 301)} | {900: -5}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [_print(t) for _, t in docs]
    want = {d: (f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, _classes(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash_near_dedup(spark, sf).collect()} == want


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "only two"), (4, "Only TWO"), (4, "Only TWO"), (None, "only two"), (None, "something else entirely here"), (9, "w " * 60_000)]
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, fp int, print string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (4, 3), (None, 3), (None, None), (9, 9)], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert materialize(df, "clash").count() == 8
