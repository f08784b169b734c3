import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
from helpers import frame, odd_rows

from quiltgraph.llm import personal as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    t = t or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = digits(m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    return out


def test_patterns_match_plain_regular_expressions():
    rng = random.Random(4)
    for _ in range(4000):
        t = "".join(rng.choice(rng.choice(["0123456789", "+@.- ()", "ab é\n%"])) for _ in range(rng.randrange(60)))
        assert P.base_spans(t) == brute(t), t
    for t in ("4111 1111-1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "x" * 50000 + "@a.bc", "9" * 5000, "1" * 3000 + ".2.3.4", "+1 (988) 555-2485", "@" * 3000):
        assert P.base_spans(t) == brute(t)


TEXTS = [
    "write to anna.27@mail.example.com or call +1 (988) 555-2485 soon. Later: 988-555-2485 again, user anna.27@ once more",
    "numbers 12 and 2024 and 1234567 are plain, host 10.20.30.40 is not",
    "card 4111 1111 1111 1111 stands here",
] * 20


def test_skip_links_find_another_form():
    field = P.fit(TEXTS)
    base = [P.base_spans(t) for t in TEXTS]
    more = field.added(TEXTS, base)
    assert more[1] == [] and more[2] == []
    found = [TEXTS[0][s:e] for _, s, e in more[0]]
    assert "988-555-2485" in found


def test_spans_are_the_same_alone_and_in_a_batch():
    unary = np.zeros((P.FEATURES, 5))
    unary[:, 3] = 4.0
    field = P.Field(unary, 6 * np.diag([0, 1, 1, 1, 1]) - 3)  # neighbours alone can settle a kind
    texts = [TEXTS[0], "card 4111 1111 1111 1111  1234", "4111 1111 1111 1112", "no tokens", ""]
    base = [P.base_spans(t) for t in texts]
    alone = [field.added([t], [b])[0] for t, b in zip(texts, base, strict=True)]
    assert field.added(texts, base) == alone
    assert alone[1] and alone[2]  # without a link, and without a base span


def test_windows_give_the_spans_of_the_whole_field(monkeypatch):
    rng = random.Random(8)
    field = P.fit(TEXTS)
    parts = ["988-555-2485", "+1 (988) 555-2485", "anna.27@", "anna.27@mail.example.com", "1234567", "word", "x,", "10.20.30.40", "(988)", "a1", "a2", "7"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(0, 120))) for _ in range(30)]
    base = [P.base_spans(t) for t in texts]
    whole = field.added(texts, base)
    t = P.Tokens(texts, base)
    before, after = t.skips()
    for window, loose in ((7, 2), (40, 50), (1, 10**9)):
        monkeypatch.setattr(P, "WINDOW", window)
        monkeypatch.setattr(P, "LOOSE", loose)
        cuts = list(P.windows(t, before, after))
        assert [lo for lo, *_ in cuts] == [0, *(hi for _, hi, _ in cuts[:-1])] and cuts[-1][1] == len(t)
        assert loose == 2 or max(len(nodes) for *_, nodes in cuts) < len(t) / 2
        assert field.added(texts, base) == whole
    assert sum(map(len, whole)) > 20


def test_a_token_of_a_long_text_takes_few_bytes():
    text = "12 " * 400_000
    field = P.fit(TEXTS)
    tracemalloc.start()
    try:
        assert field.added([text], [P.base_spans(text)]) == [[]]
        assert tracemalloc.get_traced_memory()[1] < 400_000 * 40 + 300 * P.WINDOW + (50 << 20)
    finally:
        tracemalloc.stop()


def enumerated(field, text):
    """Posteriors of all tokens by summing over every labelling: the field written once more, from its definition."""
    own = P.tokens(text)
    rows, keys, _ = zip(*P.features(text, own))
    label = P.label_of(own, P.base_spans(text))
    unary = np.array([[field.unary[list(r), k].sum() for k in range(5)] for r in rows])
    unary = np.clip(unary - unary[:, :1], -P.SHAPE, P.SHAPE)
    unary[:, 1:] += np.log(P.LEAK)
    for i, k in enumerate(label):
        if k:
            unary[i] = -P.OBSERVED
            unary[i, k] = 0
    links = [(i - 1, i, field.chain) for i in range(1, len(own)) if text[own[i - 1][1] : own[i][0]].isspace()]
    for key in set(keys) - {""}:
        same = [i for i, k in enumerate(keys) if k == key]
        links += [(a, b, P.SAME * np.eye(5)) for a, b in zip(same, same[1:])]
    out = np.zeros((len(own), 5))
    for y in itertools.product(range(5), repeat=len(own)):
        p = np.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(f[y[a], y[b]] for a, b, f in links))
        for i, k in enumerate(y):
            out[i, k] += p
    return out / out.sum(1, keepdims=True), label


def test_added_spans_equal_enumeration_of_the_field():
    field = P.fit(TEXTS)
    rng = random.Random(3)
    parts = ["988-555-2485", "+1 (988) 555-2485", "anna.27@", "anna.27@mail.example.com", "1234567", "word", "x,", "10.20.30.40", "(988)", "4111 1111"]
    added = 0
    for _ in range(60):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        if not 0 < len(P.tokens(text)) <= 6:
            continue
        base = P.base_spans(text)
        got = field.added([text], [base])[0]
        p, label = enumerated(field, text)
        sure = [(int(q.argmax()) - 1, *P.trimmed(text, *s)) for q, s, k in zip(p, P.tokens(text), label) if not k and q.argmax() and q.max() >= P.CERTAIN]
        sure = [x for x in sure if x[1] < x[2] and not any(a < x[2] and x[1] < b for _, a, b in base)]
        covered = {(k, i) for k, s, e in got for i in range(s, e) if not text[i].isspace()}
        assert {(k, i) for k, s, e in sure for i in range(s, e)} <= covered | {(k, i) for k, s, e in sure for i in range(s, e) if text[i] in P._EDGE}
        assert {(k, s) for k, s, _ in got} <= {(k, s) for k, s, _ in sure}
        added += len(got)
    assert added > 5


def test_tokens_are_whole_and_late_ones_count():
    long = "a" * 500 + "7" + "b" * 500
    assert P.tokens(f"x {long}\u2003y 1").tolist() == [[2, 1003], [1006, 1007]]
    text = " ".join(f"n{i}" for i in range(400)) + " call +1 (988) 555-2485"
    seen, _ = P.evidence(text)
    assert seen.total() == 403 and sum(n for (_, v), n in seen.items() if v == 4) == 3


def test_spans_do_not_depend_on_partitions(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS[:9] + ["4111 1111 1111 1112 a@b.cd 10.20.30.40 988-555-2485"] * 3)]
    docs = frame(spark, rows)
    field, other = P.train(docs.coalesce(1), len(rows)), P.train(docs.repartition(7), len(rows))
    assert np.array_equal(field.unary, other.unary) and np.array_equal(field.chain, other.chain)
    one = {r["doc_id"]: r["spans"] for r in P.find(docs.coalesce(1), field).collect()}
    assert one == {r["doc_id"]: r["spans"] for r in P.find(docs.repartition(12), field).collect()}


def test_loopy_is_exact_on_a_chain():
    rng = np.random.default_rng(1)
    unary, pot = rng.normal(size=(3, 5)), rng.normal(size=(2, 5, 5))
    joint = np.exp(unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :] + pot[0][:, :, None] + pot[1][None])
    joint /= joint.sum()
    got = P.loopy(unary, np.array([0, 1]), np.array([1, 2]), pot)
    for k, axes in enumerate(((1, 2), (0, 2), (0, 1))):
        assert np.allclose(got[k], joint.sum(axis=axes))


def test_query_columns(spark):
    rows = odd_rows(3) + [(200 + i, t) for i, t in enumerate(TEXTS[:4])]
    docs = frame(spark, rows, ["n_email", "spans"])
    field = P.train(docs, len(rows))
    got = P.find(docs, field).collect()
    assert len(got) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(brute(r[1]))
    for r in got:
        options = by[r["doc_id"]]
        assert any(hashlib.sha256(P.spell(s).encode()).hexdigest() == r["base_sha256"] and sum(k == 3 for k, *_ in s) == r["n_phone"] for s in options)
        assert any(set(P.spell(s).split(",")) - {""} <= set(r["spans"].split(",")) for s in options)
    out = {r["doc_id"]: r for r in P.masked(docs, field).collect()}
    assert "555-2485" not in out[200]["text"] and "<EMAIL>" in out[200]["text"]
    assert out[103]["text"] is None and out[104]["text"] == ""


def test_empty_table(spark):
    docs = frame(spark, [])
    assert P.find(docs, P.train(docs, 0)).count() == 0


def test_masking_overlaps():
    assert P.mask("ab12cd34", [(2, 2, 6), (3, 4, 8)]) == "ab<CARD>"
