"""Personal data by patterns and a skip-chain conditional random field (operator 3).

Base spans come from four patterns (email, ip, card, phone), leftmost and non-overlapping for each
kind; matches that fail their check (octets, Luhn and length, number of digits) are dropped.

The field adds spans. Its nodes are the tokens that hold a digit or an at sign (every other token is
clamped to "none", which cuts the chain there). Potentials:

* unary: a logistic model of the token's shape and neighbours, trained on base spans as labels; a token that the
  patterns passed over pays ``log LEAK`` for any kind, a token in a base span is observed;
* chain: neighbouring tokens, log of how often kinds follow each other against chance;
* skip: tokens of one document with the same digits (last seven of a phone-like number), the same mail name or the
  same letters, each linked to the next such token however far away, favour equal kinds.

Loopy sum-product passes run over windows of tokens, each with every token that a message can reach it from, so the
posteriors are those of the whole field; a run of neighbouring tokens whose posterior for
one kind reaches CERTAIN, and which touches no base span, becomes a span. So a number or name that
stands elsewhere in the document as personal data is found again in another form. Every document that has such tokens
is inferred, with or without base spans and links, and its spans do not depend on the other documents of its batch.
Tokens are taken whole, however long, and all tokens of a text take part, in fitting too: what is fitted on are counts of
feature sets, made where the texts are. A token is held as numbers (its place, its feature set, a 63-bit digest of its skip
key, its label), about 40 bytes, and messages are held for a window only, so a text of millions of numbers fits an executor. Where
skip links lead from a window all over a long text (LOOSE), the rest of the batch is one window, at about 300 bytes a token.

Null and empty texts have no spans. Repeated rows are judged each for itself. An empty table gives no rows;
columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import memory, slices, small_batches

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the contract, possessive (nothing follows a repeat), so that a long match keeps no stack.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Documents that the unary model is fitted on, at most about; by the hash of doc_id.
FIT_ROWS = 4_000
LEAK, CERTAIN, PASSES = 0.02, 0.9, 6
SHAPE = 4.0  # the most that a shape says for or against a kind
SAME = 10.0  # log potential of equal labels across a skip link
OBSERVED = 20.0
#: Tokens of a window, links whose messages are made at once, and how many times a window its surroundings may hold.
WINDOW, LINKS, LOOSE = 1 << 18, 1 << 15, 2

_NOT_DIGIT = re.compile(r"[^0-9]+")
_SEED = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_EDGE = "()[]{}<>\"',;:!?.|*_"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From one at sign to the next: the name is the run before it, so no text takes more than linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 2 * 19 - 1:  # every second sign at least is a digit
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    out += [(1, *s) for s in ips(text)]
    out += [(2, *s) for s in cards(text)]
    if "+" in text:
        out += [(3, *s) for s in phones(text)]
    return out


def tokens(text: str) -> np.ndarray:
    """Start and end of the blank-separated tokens that hold a digit or an at sign. No code point is looked at more than twice."""
    out, free = array("i"), 0
    m = _SEED.search(text)
    while m:
        s = m.start()
        while s > free and not text[s - 1].isspace():
            s -= 1
        end = _BLANK.search(text, m.end())
        free = end.start() if end else len(text)
        out.append(s)
        out.append(free)
        m = _SEED.search(text, free)
    return np.frombuffer(out, np.int32).reshape(-1, 2) if out else np.zeros((0, 2), np.int32)


FEATURES = 40


def look(t: str) -> tuple[tuple[int, ...], int, str]:
    """Numbers of the features of a token itself (the last apart), and its skip key."""
    core = t.strip(_EDGE)
    digits = _NOT_DIGIT.sub("", t)
    n = len(digits)
    size = (n > 0) + (n > 2) + (n > 4) + (n > 6) + (n > 8) + (n > 12) + (n > 15) + (n > 19)
    f = [0, 1 + size]
    dots = core.count(".")
    f.append(10 + min(dots, 4))
    f.append(15 + min(core.count("-"), 2))
    at = core.find("@")
    letter = any(c.isalpha() for c in core)
    f += [k for k, ok in ((18, at >= 0), (19, t[0] == "("), (20, t[0] == "+"), (21, core.isdigit()), (22, letter), (23, n and n + dots == len(core) and dots == 3), (24, at > 0 and "." in core[at:])) if ok]
    if at > 0:
        key = "m" + core[:at].casefold()
    elif letter:
        key = "w" + core.casefold()
    elif 7 <= n <= 12 and dots != 3:
        key = "p" + digits[-7:]
    elif n >= 7:
        key = ("i" + core) if dots == 3 else "d" + digits
    else:
        key = ""
    return tuple(f), 33 + min(6, len(core) // 4), key


_look = lru_cache(1 << 14)(look)


def features(text: str, spans: np.ndarray) -> Iterator[tuple[tuple[int, ...], str, bool]]:
    """Numbers of the features that hold, the skip key, and whether only blanks part it from the token before; of each token."""
    at = memoryview(spans)
    near, before, n = False, "", len(spans)
    for i in range(n):
        s, e = at[i, 0], at[i, 1]
        head, last, key = _look(text[s:e]) if e - s <= 64 else look(text[s:e])
        left = 25 + (1 + (before in "+(") if near else 0)
        follows = i + 1 < n and text[e : at[i + 1, 0]].isspace()
        right = 29 + (1 + (text[at[i + 1, 0]] == "(") if follows else 0)
        yield (*head, left, right, last), key, near
        near, before = follows, text[s]


class Tokens:
    """The tokens of some texts as arrays: ``owner``, ``span``, ``form`` (place in ``forms``, the feature sets), ``key`` (digest of the
    skip key, 0 for none), ``near`` (only blanks part it from the one before), ``label`` (1 + kind of a base span, else 0)."""

    def __init__(self, texts: list[str], base: list[list[tuple[int, int, int]]]):
        known: dict[tuple[int, ...], int] = {}
        form, key, near = array("i"), array("Q"), array("b")
        spans, labels = [], []
        for text, found in zip(texts, base, strict=True):
            own = tokens(text)
            spans.append(own)
            labels.append(label_of(own, found))
            for f, k, joined in features(text, own):
                form.append(known.setdefault(f, len(known)))
                key.append(int.from_bytes(hashlib.blake2b(k.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") | 1 if k else 0)
                near.append(joined)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in spans])
        self.span = spans[0] if len(spans) == 1 else np.concatenate([np.zeros((0, 2), np.int32), *spans])
        self.label = labels[0] if len(labels) == 1 else np.concatenate([np.zeros(0, np.int8), *labels])
        self.forms = list(known)
        self.form, self.key, self.near = np.frombuffer(form, np.int32), np.frombuffer(key, np.uint64), np.frombuffer(near, bool)

    def __len__(self) -> int:
        return len(self.span)

    def skips(self) -> tuple[np.ndarray, np.ndarray]:
        """The token of the same key before and after each token in its text, -1 for none."""
        n = len(self)
        before, after = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        keyed = np.flatnonzero(self.key).astype(np.int32)
        order = keyed[np.lexsort((self.key[keyed], self.owner[keyed]))]
        one, two = order[:-1], order[1:]
        same = (self.key[one] == self.key[two]) & (self.owner[one] == self.owner[two])
        before[two[same]], after[one[same]] = one[same], two[same]
        return before, after


def windows(t: Tokens, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of tokens, and for each the tokens (ascending) within PASSES links of it: no message comes from further away."""
    n, lo = len(t), 0
    inside = np.zeros(n, bool)
    while lo < n:
        hi = min(n, lo + WINDOW)
        while True:
            edge = np.arange(lo, hi, dtype=np.int32)
            inside[edge] = True
            all_, wide = [edge], hi - lo
            for _ in range(PASSES):
                left, right = edge[t.near[edge]] - 1, edge[edge + 1 < n] + 1
                right = right[t.near[right]]
                edge = np.concatenate([left, right, before[edge], after[edge]])
                edge = np.unique(edge[edge >= 0])
                edge = edge[~inside[edge]]
                inside[edge] = True
                all_.append(edge)
                wide += len(edge)
            nodes = np.concatenate(all_)
            inside[nodes] = False
            if hi == n or wide <= LOOSE * (hi - lo):
                break
            hi = n
        nodes.sort()
        yield lo, hi, nodes
        lo = hi


class Field:
    """Weights of the field: unary (FEATURES x 5) and chain (5 x 5); label 0 is none, 1 to 4 are the kinds."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray):
        self.unary, self.chain = unary, chain

    def settled(self, t: Tokens) -> np.ndarray:
        """The label of each token that the field is certain of, else 0."""
        out = np.zeros(len(t), np.int8)
        if not len(t):
            return out
        weights = scores(t.forms, self.unary)
        weights = (weights - weights[:, :1]).clip(-SHAPE, SHAPE)
        weights[:, 1:] += np.log(LEAK)
        before, after = t.skips()
        potential = np.stack([self.chain, np.eye(5) * SAME])
        for lo, hi, nodes in windows(t, before, after):
            observed = t.label[nodes]
            unary = weights[t.form[nodes]]
            fixed = np.flatnonzero(observed)
            unary[fixed] = -OBSERVED
            unary[fixed, observed[fixed]] = 0
            right = 1 + np.flatnonzero(t.near[nodes[1:]] & (nodes[1:] == nodes[:-1] + 1))
            second = np.flatnonzero(before[nodes] >= 0)
            first = np.searchsorted(nodes, before[nodes[second]])
            here = nodes[first] == before[nodes[second]]
            a, b = np.concatenate([right - 1, first[here]]).astype(np.int32), np.concatenate([right, second[here]]).astype(np.int32)
            which = np.repeat(np.array([0, 1], np.int8), [len(right), len(a) - len(right)])
            del right, second, first, here, fixed
            posterior = loopy(unary, a, b, potential, which)
            at = np.searchsorted(nodes, lo)
            posterior, observed = posterior[at : at + hi - lo], observed[at : at + hi - lo]
            best = posterior.argmax(axis=1)
            sure = (best > 0) & (observed == 0) & (posterior.max(axis=1) >= CERTAIN)
            out[lo:hi][sure] = best[sure]
        return out

    def added(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """Spans beyond the base ones, for each text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        t = Tokens(texts, base)
        label = self.settled(t)
        doc, starts, ends = -1, [], []
        for i in np.flatnonzero(label).tolist():
            d, kind = int(t.owner[i]), int(label[i]) - 1
            if d != doc:
                doc, starts, ends = d, sorted(x for _, x, _ in base[d]), sorted(y for *_, y in base[d])
            s, e = trimmed(texts[d], *t.span[i].tolist())
            if s >= e or bisect_left(starts, e) > bisect_right(ends, s):  # more spans begin before its end than end before it
                continue
            have = out[d]
            if have and t.near[i] and label[i - 1] == label[i] and have[-1][0] == kind:
                have[-1] = (kind, have[-1][1], e)
            else:
                have.append((kind, s, e))
        return out


def trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and text[s] in _EDGE and text[s] != "(":
        s += 1
    while e > s and text[e - 1] in _EDGE:
        e -= 1
    return s, e


def label_of(spans: np.ndarray, base: list[tuple[int, int, int]]) -> np.ndarray:
    """1 + kind of the base span that a token touches (the first kind, of several), else 0."""
    out = np.zeros(len(spans), np.int8)
    if base and len(spans):
        found = np.array(base, np.int64)
        found = found[np.argsort(-found[:, 0], kind="stable")]
        first = np.searchsorted(spans[:, 1], found[:, 1], "right")  # the first token that ends after it begins
        last = np.searchsorted(spans[:, 0], found[:, 2], "left")
        for kind, lo, hi in zip(found[:, 0].tolist(), first.tolist(), last.tolist(), strict=True):
            out[lo:hi] = 1 + kind
    return out


def scores(rows: list[tuple[int, ...]], weights: np.ndarray) -> np.ndarray:
    flat = np.fromiter((f for r in rows for f in r), np.int64)
    at = np.cumsum([0, *map(len, rows)])[:-1]
    return np.add.reduceat(weights[flat], at, axis=0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def loopy(unary: np.ndarray, a: np.ndarray, b: np.ndarray, potential: np.ndarray, which: np.ndarray | None = None, passes: int = PASSES) -> np.ndarray:
    """Posterior of each node after some passes of sum-product messages along the links a-b (exact on trees that they span).

    ``which`` names the potential of each link; without it, link k has the k-th one."""
    which = np.arange(len(a)) if which is None else which
    to_a, to_b = np.zeros((len(a), unary.shape[1])), np.zeros((len(b), unary.shape[1]))

    def gather() -> None:
        belief[:] = unary
        for s in range(0, len(a), LINKS):
            np.add.at(belief, a[s : s + LINKS], to_a[s : s + LINKS])
        for s in range(0, len(a), LINKS):
            np.add.at(belief, b[s : s + LINKS], to_b[s : s + LINKS])

    belief = np.empty_like(unary)
    for _ in range(passes):
        gather()
        for s in range(0, len(a), LINKS):  # beliefs are those before the pass, so messages can take the place of old ones
            at = slice(s, s + LINKS)
            p = potential[which[at]]
            new_b = _log_sum((belief[a[at]] - to_a[at])[:, :, None] + p, 1)
            new_a = _log_sum((belief[b[at]] - to_b[at])[:, None, :] + p, 2)
            to_a[at], to_b[at] = new_a - _log_sum(new_a, 1)[:, None], new_b - _log_sum(new_b, 1)[:, None]
    gather()
    for s in range(0, len(belief), LINKS):
        part = belief[s : s + LINKS]
        belief[s : s + LINKS] = np.exp(part - _log_sum(part, 1)[:, None])
    return belief


def evidence(text: str) -> tuple[Counter, Counter]:
    """What a text teaches: how often (features, label) of its tokens, and labels of neighbouring tokens."""
    t = Tokens([text], [base_spans(text)])
    # another form of a known span is neither for nor against
    used = (t.label > 0) | ~np.isin(t.key, t.key[(t.label > 0) & (t.key > 0)])
    seen, n = np.unique(t.form[used].astype(np.int64) * 5 + t.label[used], return_counts=True)
    right = np.flatnonzero(t.near)
    pairs, m = np.unique(t.label[right - 1].astype(np.int64) * 5 + t.label[right], return_counts=True)
    return (
        Counter({(t.forms[x // 5], x % 5): k for x, k in zip(seen.tolist(), n.tolist(), strict=True)}),
        Counter({(x // 5, x % 5): k for x, k in zip(pairs.tolist(), m.tolist(), strict=True)}),
    )


def fitted(seen: dict[tuple[tuple[int, ...], int], int], follows: dict[tuple[int, int], int], steps: int = 150) -> Field:
    """Piecewise training from counts: unary weights by multinomial logistic regression, chain potentials from pairs."""
    weights = np.zeros((FEATURES, 5))
    if seen:
        rows = sorted(seen)  # one order, so that sums do not hang on where the counts were made
        x, y, n = np.zeros((len(rows), FEATURES)), np.zeros((len(rows), 5)), np.array([seen[r] for r in rows], float)
        for i, (f, label) in enumerate(rows):
            x[i, list(f)] = 1
            y[i, label] = 1
        n = (n / n.sum())[:, None]
        for _ in range(steps):
            p = np.exp((z := x @ weights) - _log_sum(z, 1)[:, None])
            weights += 2.0 * (x.T @ (n * (y - p)) - 1e-4 * weights)
    pairs = np.full((5, 5), 0.5)
    for (a, b), k in follows.items():
        pairs[a, b] += k
    p = pairs / pairs.sum()
    return Field(weights, np.log(p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True))).clip(-3, 3))


def fit(texts: list[str]) -> Field:
    """A field from texts at hand."""
    seen, follows = Counter(), Counter()
    for text in texts:
        own, pairs = evidence(text)
        seen.update(own)
        follows.update(pairs)
    return fitted(seen, follows)


def train(docs: DataFrame, rows: int) -> Field:
    """Fit on about FIT_ROWS whole texts (all, in a smaller table). Only counts leave the tasks: one row a feature set and label
    (a feature set is one of 8 x 5 x 3 x 2**7 x 3 x 3 x 7), whatever the texts hold."""
    rate = min(1.0, FIT_ROWS / max(1, rows))
    pick = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    sample = small_batches(docs).where(pick & F.col("text").isNotNull()).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            seen = Counter()
            for text in b.column("text").to_pylist():
                own, pairs = evidence(text)
                seen.update(own)
                seen.update({(None, p): k for p, k in pairs.items()})
            keys = [(f, label, None) if f is not None else (None, label[0], label[1]) for f, label in seen]
            kinds = (pa.list_(pa.int32()), pa.int32(), pa.int32())
            cols = zip(*keys, strict=True) if keys else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array(list(seen.values()), pa.int64())], ["f", "label", "next", "n"])

    counts = sample.mapInArrow(count, "f array<int>, label int, next int, n long").groupBy("f", "label", "next").agg(F.sum("n").alias("n")).collect()
    return fitted({(tuple(r["f"]), r["label"]): r["n"] for r in counts if r["f"] is not None}, {(r["label"], r["next"]): r["n"] for r in counts if r["f"] is None})


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in capitals; where spans overlap, one mark for all."""
    out, end = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < end:
            out.append("")
            end = max(end, e)
            continue
        out += [text[end:s], f"<{KINDS[k].upper()}>"]
        end = e
    return "".join([*out, text[end:]])


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans (all), n_added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = field.added(texts, base)
            n = [np.bincount([k for k, *_ in s], minlength=4) if s else np.zeros(4, np.int64) for s in base]
            counts = np.array(n, np.int64).reshape(len(texts), 4)
            digest = [hashlib.sha256(spell(s).encode()).hexdigest() for s in base]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(counts[:, k]) for k in range(4)), pa.array(digest, pa.string()), pa.array([spell(s + m) for s, m in zip(base, more, strict=True)], pa.string()), pa.array([len(m) for m in more], pa.int64())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """The documents (their five columns) with every span masked in the text; n_chars follows a changed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory("personal")
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            plain = [t or "" for t in texts]
            base = [base_spans(t) for t in plain]
            more = field.added(plain, base)
            new = [t if t is None or not s + m else mask(t, s + m) for t, s, m in zip(texts, base, more, strict=True)]
            size = [n if t is u or u is None else len(u) for t, u, n in zip(texts, new, b.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(new, pa.string()), b.column("lang"), b.column("source"), pa.array(size, pa.int64())], ["doc_id", "text", "lang", "source", "n_chars"])

    kept = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    return kept.mapInArrow(run, "doc_id long, text string, lang string, source string, n_chars long")
