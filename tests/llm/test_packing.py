import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textloom.llm.packing import Capacity, cut, pack, pack_documents, plan_bins, token_ids
from textloom.llm.queries import op9_best_fit_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
HF = Tokenizer.from_file(PATH)
HF.encode_special_tokens = True
#: As the file has it.
PLAIN = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_the_library_s(text):
    assert token_ids(text, PATH).tolist() == [*HF.encode(text, add_special_tokens=False).ids, 2]


def test_long_and_special_texts():
    for text in ("<|endoftext|> a", "a" * 60_000, " " * 60_000, "x \n\t " * 9000, "don't WE'RE 123abc"):
        assert token_ids(text, PATH).tolist() == [*HF.encode(text, add_special_tokens=False).ids, 2]


ADDED = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|>", " x <|endoftext|>  y\n<|endoftext|", "é🔥<|endoftext|> don't <|ENDOFTEXT|>"]


def test_added_tokens_against_the_unmodified_library(spark):
    assert token_ids("a<|endoftext|>b", PATH, added=True).tolist() == [64, 50256, 65, 2]
    for text in [*ADDED, "", "no such token"]:
        assert token_ids(text, PATH, added=True).tolist() == [*PLAIN.encode(text, add_special_tokens=False).ids, 2]
    got = pack_documents(spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string"), PATH, carry=["doc_id"]).collect()
    for r in got:
        ids = np.array([*PLAIN.encode(ADDED[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    assert len(got) == len(ADDED)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", "1", "é", "'s", "<"]), max_size=20))
def test_added_tokens_anywhere(parts):
    text = "".join(parts)
    assert token_ids(text, PATH, added=True).tolist() == [*PLAIN.encode(text, add_special_tokens=False).ids, 2]


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def _bins(histogram, capacity):
    plan = plan_bins(histogram, capacity)
    found = defaultdict(list)
    for length, n in histogram.items():
        where, offset = plan.place(np.full(n, length), np.arange(n))
        for b, o in zip(where.tolist(), offset.tolist(), strict=True):
            found[b].append((o, length))
    assert len(found) == plan.bins and set(found) == set(range(plan.bins))
    for members in found.values():
        at = 0
        for o, length in sorted(members):
            assert o == at
            at += length
        lengths = [m[1] for m in members]
        assert sum(lengths) <= capacity.tokens and len(lengths) <= capacity.documents and sum(x * x for x in lengths) <= capacity.cost
    return plan.bins


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20), st.sampled_from(["norm", "dot"]), st.integers(2, 64), st.integers(64 * 64, 64 * 64))
def test_every_constraint_holds(histogram, choose, documents, cost):
    _bins(histogram, Capacity(64, documents, cost, (1, 0.3, 0.2), choose))


def _brute(histogram, capacity):
    """Vector best fit bin by bin: the contents of all bins, each a sorted tuple of lengths."""
    caps, bins = (capacity.tokens, capacity.documents, capacity.cost), []
    for length in sorted(histogram, reverse=True):
        item, todo = (length, 1, length * length), histogram[length]
        while todo:
            best = None
            for b in bins:
                if all(r >= x for r, x in zip(b[0], item, strict=True)):
                    share, part = [r / c for r, c in zip(b[0], caps, strict=True)], [x / c for x, c in zip(item, caps, strict=True)]
                    terms = zip(capacity.weights, share, part, strict=True)
                    score = sum(w * (s - p) ** 2 for w, s, p in terms) if capacity.choose == "norm" else -sum(w * s * p for w, s, p in terms)
                    if best is None or score < best[0] - 1e-12:
                        best = (score, b)
            if best is None:
                bins.append((list(caps), []))
                best = (0, bins[-1])
            room, held = best[1]
            n = min(todo, *(r // x for r, x in zip(room, item, strict=True)))
            for k in range(3):
                room[k] -= n * item[k]
            held += [length] * n
            todo -= n
    return Counter(tuple(sorted(held)) for _, held in bins)


def _contents(histogram, capacity):
    plan, found = plan_bins(histogram, capacity), defaultdict(list)
    for length, n in histogram.items():
        for b in plan.place(np.full(n, length), np.arange(n))[0].tolist():
            found[b].append(length)
    return Counter(tuple(sorted(x)) for x in found.values())


def test_every_capacity_changes_the_packing_as_bin_by_bin():
    rng = random.Random(9)
    changed = Counter()
    for choose in ("norm", "dot"):
        for _ in range(40):
            histogram = {rng.randrange(1, 40): rng.randrange(1, 9) for _ in range(12)}
            plain = Capacity(64, 64, 64 * 64, (1.0, 0.0, 0.0), choose)
            for name, own in {"documents": Capacity(64, 6, 64 * 64, (1.0, 0.011, 0.017), choose), "cost": Capacity(64, 64, 1700, (1.0, 0.011, 0.017), choose), "document weight": Capacity(64, 12, 64 * 64, (1.0, 2.0, 0.013), choose), "cost weight": Capacity(64, 64, 64 * 64, (1.0, 0.013, 4.0), choose), "all": Capacity(64, 12, 2000, (1.0, 0.25, 0.25), choose)}.items():
                got = _contents(histogram, own)
                assert got == _brute(histogram, own), (name, histogram)
                changed[name] += got != _contents(histogram, plain)
    assert all(n >= 5 for n in changed.values()) and len(changed) == 5


def test_attention_cost_binds():
    assert _bins({32: 10}, Capacity(64, 64, 64 * 64)) == 5
    assert _bins({32: 10}, Capacity(64, 64, 32 * 32)) == 10
    with pytest.raises(ValueError):
        plan_bins({65: 1}, Capacity(64, 64, 64 * 64))
    assert _bins({8: 80}, Capacity(64, 64, 2 * 64)) == 40
    assert _bins({8: 80}, Capacity(64, 4, 64 * 64)) == 20


def _best_fit_decreasing(lengths, cap):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= x
        else:
            rooms.append(cap - x)
    return len(rooms)


def test_as_few_bins_as_piecewise_best_fit():
    rng = random.Random(5)
    for _ in range(30):
        lengths = [min(64, int(rng.paretovariate(0.7) * 4)) for _ in range(300)]
        assert _bins(Counter(lengths), Capacity(64, 64, 64 * 64)) <= _best_fit_decreasing(lengths, 64) + 1


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (4, "word " * 5000), (None, "x y"), (5, "w" * 9)] + [(9, "copy of one text")] * 200
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    got = pack_documents(df, PATH, carry=["doc_id"]).collect()
    whole = defaultdict(list)
    for r in got:
        whole[r.sequence_id].append((r.offset, r.length))
    for members in whole.values():
        assert [o for o, _ in sorted(members)] == list(np.cumsum([0, *(n for _, n in sorted(members))]))[:-1]
    assert Counter(r.doc_id for r in got)[9] == 200
    ids = token_ids("word " * 5000, PATH)
    own = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 4)
    assert [x[1:3] for x in own] == cut(len(ids), 1024)
    assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for _, s, n, c in own)
    assert len(whole) == -(-sum(r.length for r in got) // 1024)
    assert pack_documents(df.limit(0), PATH, carry=["doc_id"]).count() == 0
    again = pack(df.select("doc_id", "length").withColumn("offset", df.doc_id))
    assert again.columns == ["doc_id", "length", "sequence_id", "offset"] and again.count() == len(rows)


def test_query(spark):
    got = op9_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    total = {d: len(HF.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in docs.items()}
    by = Counter()
    for r in got:
        by[r.doc_id] += r.length
    assert by == total
    assert len({r.sequence_id for r in got}) <= -(-sum(total.values()) // 1024) + 1
