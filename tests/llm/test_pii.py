import hashlib
import random
import re

from textloom.llm import pii
from textloom.llm.queries import op7_contextual_pii

FORMS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _base(text):
    found = []
    for kind, form in enumerate(FORMS):
        for m in form.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = (True, kind == 1 and all(int(p[-18:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")), 12 <= len(digits) <= 19 and _luhn(digits), 9 <= len(digits) <= 15)[kind]
            if keep:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def _listed(found):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found)


def _card(rng, n):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if _luhn(body + c))


def _texts():
    rng = random.Random(6)
    pool = ["a@b.co", "@", ".", "x_y%+z", "_", "-", " ", "+1", "+", "(555)", "123", "4", "12.34.56.78", "256.1.1.1", "000255.01.2.3", "é", "🔥", "\n", "mail", "a.b@c-d.e.f", "4111 1111-1111 1111", "1.2.3", "  "]
    own = ["".join(rng.choice([*pool, _card(rng, 13), _card(rng, 16)]) for _ in range(rng.randrange(25))) for _ in range(500)]
    return [*own, "a@b.c_x@d.e", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1-1-1-1-1-1-1-1-1-", "0" * 13, _card(rng, 19) + "0", _card(rng, 12)]


def test_base_spans_against_brute_force(spark):
    texts = [*_texts(), None, "", "a" * 100_000, "1" * 60_000, "a." * 40_000 + "@", "1 " * 60_000, "+1" + " " * 50_000, "a@b" + ".c" * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(pii.find(df, carry=["doc_id"]), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        want = _base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(_listed(want).encode()).hexdigest(), (t or "")[:200]
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(k == x[1] for x in want) for k in range(4))
        assert set(_listed(want).split(",")) - {""} <= set(got[i].spans.split(","))


def _rate(edges, support, least, value_least, rounds):
    """Brute force of the graph scoring: edges (pattern, value, kind or None, shapes)."""
    known = {v: (k, 1.0) for _, v, k, _ in edges if k is not None}
    first = set(known)
    for _ in range(rounds):
        rating = {}
        for p in {e[0] for e in edges}:
            values = [e[1] for e in edges if e[0] == p]
            sums = [sum(known[v][1] for v in values if v in known and known[v][0] == k) for k in range(4)]
            if any(v not in known for v in values) and max(sums) >= support and max(sums) >= least * len(values):
                rating[p] = (sums.index(max(sums)), min(0.999, max(sums) / len(values)))
        doubt = {}
        for p, v, _, shapes in edges:
            if v not in known and p in rating and shapes[rating[p][0]]:
                key = (v, rating[p][0])
                doubt[key] = doubt.get(key, 1.0) * (1 - rating[p][1])
        new = {}
        for (v, k), d in sorted(doubt.items()):
            if 1 - d >= value_least and (v not in new or 1 - d > new[v][1]):
                new[v] = (k, 1 - d)
        if not new:
            break
        known |= new
    return {v: k for v, (k, _) in known.items() if v not in first}


def test_graph_against_brute_force(spark):
    rng = random.Random(11)
    edges = {}
    for _ in range(400):
        p, v = f"p{rng.randrange(12)}", f"v{rng.randrange(120)}"
        i = int(v[1:])
        edges[p, v] = (0 if i < 40 else 2 if i < 80 and int(p[1:]) % 2 else None) if i < 80 else None
    kinds = {v: 0 if int(v[1:]) < 40 else 2 if int(v[1:]) < 80 else None for _, v in edges}
    rows = [(p, v, kinds[v], [int(v[1:]) % 3 > 0] * 4) for p, v in sorted(edges)]
    for least in (0.3, 0.45, 0.6):
        want = _rate(rows, 4, least, 0.6, 3)
        got = pii.bootstrap(spark.createDataFrame(rows, "pattern string, value string, kind int, shapes array<boolean>"), 3, 4, least, 0.6)
        assert ({} if got is None else {r.value: r.kind for r in got.collect()}) == want


def test_contexts_find_unseen_forms(spark):
    rows = [(i, f"Hello, write to user{i}@mail.example.org now", "c") for i in range(60)]
    rows += [(100, "é please write to someone@localhost today", "c"), (100, "é please write to someone@localhost today", "c"), (101, "we saw someone@localhost", "c"), (102, "look at other@localhost", "c"), (103, "write to nobody", "c"), (None, None, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = {r.doc_id: r.spans for r in pii.report(pii.find(df, carry=["doc_id"]), ["doc_id"]).collect()}
    assert got[100] == "ctx_email:18:35" and got[101] == "ctx_email:7:24"
    assert got[102] == got[103] == got[None] == ""
    assert pii.find(df.limit(0), carry=["doc_id"]).count() == 0


def _spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.spans for r in pii.report(pii.find(df, carry=["doc_id"]), ["doc_id"]).orderBy("doc_id").collect()]


SEEDED = [f"Hello, write to user{i}@mail.example.org now" for i in range(60)]


def test_identifiers_of_any_length_and_late_digits(spark):
    names = ["x" * 300 + "@host", "y" * 200 + "@" + "z" * 300, "@" + "q" * 90_000, "a." * 500 + "@b"]
    got = _spans(spark, [*SEEDED, *(f"please write to {n} today" for n in names), *(f"please write to {n}." for n in names)])[len(SEEDED) :]
    assert got == [f"ctx_email:16:{16 + len(n)}" for n in names] * 2


def test_lists_and_earlier_entities_lend_patterns(spark):
    lists = [f"mail a{i}@b.com or c{i}@d.org" for i in range(60)]
    assert _spans(spark, [*lists, "mail z@b.com or x@localhost", "mail 12/34/56 or y@localhost"])[-2] == "email:5:12,ctx_email:16:27"
    rows = [f"to: a{i}@b.com, c{i}@d.org, e{i}@f.net" for i in range(60)]
    assert _spans(spark, [*rows, "to: a@b.com, x@localhost"])[-1] == "email:4:11,ctx_email:13:24"


def test_words_before_of_any_length(spark):
    long, other = "w" * 5000, "w" * 4999 + "v"
    seeds = [f"see {long} {long} a{i}@b.com" for i in range(30)]
    at = 4 + 2 * 5001
    assert _spans(spark, [*seeds, f"see {long} {long} x@localhost", f"see {other} {long} z@localhost"])[-2:] == [f"ctx_email:{at}:{at + 11}", ""]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_contextual_pii(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(_listed(_base(docs[r.doc_id] or "")).encode()).hexdigest()
