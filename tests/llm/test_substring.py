import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from helpers import frame, odd_rows, prose, split

from quiltgraph.llm import substring
from quiltgraph.llm.common import NO_ID
from quiltgraph.llm.fm_index import FmIndex
from quiltgraph.llm.textual import single_spaced, word_hashes, words


def place(d, t, i):
    """Order of places: id (null last), hash of the text as Spark makes it, word."""
    h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    return (NO_ID if d is None else d, h - (h >> 63 << 64), i)


def brute(rows, window=20):
    first = {}
    for d, t, *_ in rows:
        ws = split(t)
        for i in range(len(ws) - window + 1):
            k = tuple(ws[i : i + window])
            here = place(d, t, i)
            first[k] = min(first.get(k, here), here)
    out = []
    for d, t, *_ in rows:
        ws = split(t)
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < place(d, t, i):
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter(map(tuple, substring.dedup(df).collect()))


def test_matches_brute_force(spark):
    rows = odd_rows(1)
    assert got(frame(spark, rows, ["anchor", "did", "starts"])) == brute(rows)


def test_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT", 2)
    rng = random.Random(5)
    line = prose(rng, 26)
    rows = [(i, f"{prose(rng, 9)} {line} {prose(rng, 30)}") for i in range(12)]
    assert got(frame(spark, rows)) == brute(rows)


def test_repetitive_text(spark):
    rows = [(0, "a " * 60), (1, "b a " * 40 + "a " * 30), (2, "a b " * 25)]
    assert got(frame(spark, rows)) == brute(rows)


def test_null_and_repeated_ids(spark):
    rng = random.Random(8)
    line = prose(rng, 30)
    rows = [(None if i % 2 else 7, f"{prose(rng, i + 1)} {line}  {prose(rng, 12)}") for i in range(10)]
    rows += [rows[0], rows[1], rows[1], (3, line)]
    assert got(frame(spark, rows)) == brute(rows)


def thue_morse(n):
    t = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_words_that_a_polynomial_modulo_a_power_of_two_takes_for_one(spark):
    a, b = thue_morse(2048)
    w = words(pa.array([f"{a} {b}"]))
    assert len(set(word_hashes(w).tolist())) == 2
    rest = prose(random.Random(2), 19)
    rows = [(0, f"{a} {rest}"), (1, f"{b} {rest}")]
    assert got(frame(spark, rows)) == brute(rows)
    assert all(r[2] == 0 for r in got(frame(spark, rows)))


def test_hashes_tell_lengths_and_bytes_apart():
    texts = ["", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "a" * 32, "a" * 33, "a" * 40, "é", "e\u0301", "b" + "a" * 31, "b" + "a" * 40]
    h = word_hashes(words(pa.array(texts)))
    assert len(set(h.tolist())) == len(texts) - 1
    again = word_hashes(words(pa.array([" ".join(texts)])))
    assert again.tolist() == h.tolist()


def test_single_spaced():
    raw, start, end = single_spaced(words(pa.array([" a\t\tbc ", "", "d\n", "é f"])))
    assert [raw[i:j].decode() for i, j in zip(start, end)] == ["a", "bc", "d", "é", "f"] and raw.decode() == "a bc d é f "


def test_empty_table(spark):
    assert got(frame(spark, [])) == Counter()


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 300)
    text[[50, 200]] = 0
    index = FmIndex(text, 5, 6)
    patterns, at = rng.integers(-1, 5, 120), np.array([0, 40, 40, 120])
    patterns[patterns == 0] = 1
    length, first = index.matching_statistics(patterns, at)
    whole = ",".join(map(str, text))
    for i, j in zip(at, at[1:]):
        for p in range(i, j):
            want = max(m for m in range(min(6, j - p) + 1) if m == 0 or "," + ",".join(map(str, patterns[p : p + m])) + "," in f",{whole},")
            assert length[p] == want
            if want:
                s = index.least(first[p : p + 1])[0]
                assert (text[s : s + want] == patterns[p : p + want]).all()
