"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. Tokens that hold a digit or an ``@`` are the
variables of the field (any other token is no entity and ends a chain). Base
tokens are observed. Neighbouring tokens share a chain potential; equal or similar
tokens, however far apart in the document, share a skip potential. Loopy belief
propagation decides the rest, so that what is an entity in one place is one
wherever it returns.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.ragged import chunks
from barline.llm.store import Carried

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
# The base patterns. Lookbehinds and possessive runs only keep them linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = re.compile(r"[0-9]")
SIGNS = re.compile(r"[0-9@]")
SPACES = " \t\n\x0b\x0c\r"
SPACE = re.compile(r"[\x20\x09-\x0D]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]
#: Rounds of message passing at most, the change at which messages have settled, and their damping.
ROUNDS, SETTLED, DAMPING = 200, 1e-4, 0.3
#: Bounds of the learned skip and chain potentials.
MOST_SKIP, MOST_CHAIN = 8.0, 2.0
#: Digits from which two tokens with the same digits are similar.
SIMILAR_DIGITS = 7


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = at + 1  # no match can hold this sign: what stands before it is used up
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping spans of each kind, by kind and start."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not DIGITS.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


@dataclass
class Tokens:
    """Candidate tokens of one text."""

    start: list[int]
    end: list[int]
    pattern: list[int]
    label: list[int]
    keys: list[tuple[str, ...]]


def _pattern(token: str, digits: str) -> int:
    """Form of a token, as bits: eight sizes of its digits, then signs it holds."""
    n = len(digits)
    size = sum(n >= k for k in (1, 4, 7, 9, 13, 16, 20))
    flags = ("@" in token, token.startswith("+"), "." in token, token.count(".") == 3, "-" in token,
             any(c.isalpha() for c in token), 13 <= n <= 19 and luhn(digits))
    return size | sum(f << i + 3 for i, f in enumerate(flags))


def tokens_of(text: str, base: list[Span]) -> Tokens:
    out = Tokens([], [], [], [], [])
    spans = sorted((a, b, LABELS.index(k)) for k, a, b in base)
    stop, place = 0, 0
    while m := SIGNS.search(text, stop):
        before = max(text.rfind(c, stop, m.start()) for c in SPACES)
        start = before + 1 if before >= 0 else stop
        gap = SPACE.search(text, m.end())
        stop = gap.start() if gap else len(text)
        token = text[start:stop]
        digits = NOT_DIGIT.sub("", token)
        while place < len(spans) and spans[place][1] <= start:
            place += 1
        label, keys = 0, [token.casefold().strip(".,;:!?()[]<>\"'")] if len(digits) > 4 or "@" in token else []
        if len(digits) >= SIMILAR_DIGITS:
            keys.append(digits.lstrip("0"))
        if place < len(spans) and spans[place][0] < stop:
            a, b, label = spans[place]
            if a >= start and label >= 3 and (b > stop):  # a number over several tokens is known by all its digits
                keys.append(NOT_DIGIT.sub("", text[a:b]).lstrip("0"))
        out.start.append(start)
        out.end.append(stop)
        out.pattern.append(_pattern(token, digits))
        out.label.append(label)
        out.keys.append(tuple(dict.fromkeys(keys)))
    return out


def _edges(t: Tokens, text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges of tokens next to each other, and skip edges from each
    occurrence of a key to the first one, so that any two occurrences are two edges apart."""
    chain = [(i, i + 1) for i in range(len(t.start) - 1)
             if not text[t.end[i]:t.start[i + 1]].strip(SPACES)]
    skip, first = set(), {}
    for i, keys in enumerate(t.keys):
        for key in keys:
            if first.setdefault(key, i) != i:
                skip.add((first[key], i))
    return chain, sorted(skip)


def _evidence(t: Tokens, skip: list[tuple[int, int]]) -> list[int]:
    """Per token the kinds (bits) of the base spans that skip edges reach from it."""
    root = list(range(len(t.label)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, j in skip:
        root[top(j)] = top(i)
    seen: dict[int, int] = defaultdict(int)
    for i, y in enumerate(t.label):
        seen[top(i)] |= (1 << y) & ~1
    return [seen[top(i)] for i in range(len(root))]


def _possible(pattern: int) -> int:
    """The kinds (bits) that the form of a token allows: an email has a sign, an
    ip three dots, a card 13 to 19 digits and a phone 9 to 15."""
    size = pattern & 7
    return (pattern >> 3 & 1) << 1 | (pattern >> 6 & 1) << 2 | (size in (5, 6)) << 3 | (size in (4, 5)) << 4


@dataclass
class Field:
    """Potentials: ``unary`` per pattern, ``chain`` per pair of labels, ``skip`` for agreement."""

    unary: dict[int, np.ndarray]
    weights: np.ndarray
    chain: np.ndarray
    skip: float

    def of(self, pattern: int) -> np.ndarray:
        if pattern not in self.unary:
            self.unary[pattern] = _features(np.array([pattern]))[0] @ self.weights
        return self.unary[pattern]


def _features(patterns: np.ndarray) -> np.ndarray:
    size, flags = patterns & 7, patterns >> 3
    return np.concatenate((np.ones((len(patterns), 1)), size[:, None] == np.arange(8), flags[:, None] >> np.arange(7) & 1), axis=1).astype(float)


def counts_of(docs: DataFrame) -> DataFrame:
    """``what``, ``x``, ``y``, ``n``: how often token forms, neighbouring labels
    and labels of similar tokens occur in the whole corpus. The table is bounded
    by the forms there are; each task sends each of them once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[str, int, int], int] = defaultdict(int)
        for rows in batches:
            for text in rows["t"]:
                if not text or not SIGNS.search(text):
                    continue
                t = tokens_of(text, base_spans(text))
                for p, y in zip(t.pattern, t.label):
                    total["form", p, y] += 1
                chain, skip = _edges(t, text)
                for i, j in chain:
                    total["chain", t.label[i], t.label[j]] += 1
                for i, j in skip:
                    total["skip", t.label[i], t.label[j]] += 1
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["what", "x", "y", "n"])

    made = docs.select(docs["text"].alias("t")).mapInPandas(run, "what string, x int, y int, n long")
    return made.groupBy("what", "x", "y").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Field:
    """Train the field on the base labels of all documents."""
    rows = counts_of(docs).collect()
    form = [(r["x"], r["y"], r["n"]) for r in rows if r["what"] == "form"]
    tables = {w: np.zeros((5, 5)) for w in ("chain", "skip")}
    for r in rows:
        if r["what"] != "form":
            tables[r["what"]][r["x"], r["y"]] += r["n"]
    weights = np.zeros((16, 5))
    weights[0, 0] = 1.0
    if form:
        x, y, n = (np.array(v) for v in zip(*sorted(form)))
        f, target, share = _features(x), np.eye(5)[y], n / n.sum()
        for _ in range(800):  # softmax regression, full gradient
            score = f @ weights
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights += 2.0 * (f.T @ ((target - p) * share[:, None]) - 1e-4 * weights)
    chain = tables["chain"] + 1.0
    chain = np.log(chain * chain.sum() / (chain.sum(axis=1, keepdims=True) * chain.sum(axis=0, keepdims=True)))
    entity = tables["skip"][1:, 1:]
    agree = np.trace(entity)
    skip = float(np.clip(np.log((agree + 1) / (entity.sum() - agree + 1)), 0.0, MOST_SKIP))
    return Field({}, weights, np.clip(chain, -MOST_CHAIN, MOST_CHAIN), skip)


def beliefs(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, field: Field) -> np.ndarray:
    """Marginals of all tokens of a batch of documents, by loopy sum-product."""
    edges = np.concatenate((chain, skip)).astype(np.int64).reshape(-1, 2)
    if not len(edges):
        e = np.exp(unary - unary.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    table = np.stack((np.exp(field.chain), np.exp(field.skip * np.eye(5))))
    kind = np.repeat((0, 1), (len(chain), len(skip)))
    forward = table[kind]
    pair = np.concatenate((forward, forward.transpose(0, 2, 1)))  # both ways
    source = np.concatenate((edges[:, 0], edges[:, 1]))
    target = np.concatenate((edges[:, 1], edges[:, 0]))
    back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
    message = np.zeros((len(source), 5))
    for _ in range(ROUNDS):
        total = unary.copy()
        np.add.at(total, target, message)
        out = total[source] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(np.einsum("es,est->et", out, pair) + 1e-30)
        new -= new.max(axis=1, keepdims=True)
        new = DAMPING * message + (1 - DAMPING) * new
        moved, message = np.abs(new - message).max(), new
        if moved < SETTLED:
            break
    total = unary.copy()
    np.add.at(total, target, message)
    e = np.exp(total - total.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Per text: base spans, and all spans; both by kind and start.

    A free token can only have a kind that its form allows and that a base span
    has which skip edges reach, so texts without base spans have no others.
    """
    base = [base_spans(t) if t and SIGNS.search(t) else [] for t in texts]
    found = [(b, b) for b in base]
    held, unary, chains, skips, at = [], [], [], [], 0
    for k, text in enumerate(texts):
        if not base[k]:
            continue
        t = tokens_of(text, base[k])
        chain, skip = _edges(t, text)
        open_ = [0 if y else seen & _possible(p) for p, y, seen in zip(t.pattern, t.label, _evidence(t, skip))]
        if not any(open_):
            continue
        held.append((k, t, at))
        for p, y, kinds in zip(t.pattern, t.label, open_):
            may = np.arange(5) == y if y else (kinds | 1) >> np.arange(5) & 1 == 1
            unary.append(np.where(may, 0.0 if y else field.of(p), -50.0))
        chains += [(i + at, j + at) for i, j in chain]
        skips += [(i + at, j + at) for i, j in skip]
        at += len(t.start)
    if not held:
        return found
    marginal = beliefs(np.array(unary), np.array(chains).reshape(-1, 2), np.array(skips).reshape(-1, 2), field)
    choice = np.where(marginal.max(axis=1) > 0.5, marginal.argmax(axis=1), 0)
    for k, t, at in held:
        added = _added(texts[k], t, choice[at:at + len(t.start)].tolist(), base[k])
        if added:
            found[k] = base[k], sorted(base[k] + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return found


def _added(text: str, t: Tokens, choice: list[int], base: list[Span]) -> list[Span]:
    """Spans of the free tokens that were given a kind. Tokens one space apart
    are one span only if together they have the digits of a base span of that kind."""
    known = {(k, NOT_DIGIT.sub("", text[a:b]).lstrip("0")) for k, a, b in base if k in ("card", "phone")}
    out: list[Span] = []
    i = 0
    while i < len(choice):
        y, last = 0 if t.label[i] else choice[i], i
        j = i
        while y and j + 1 < len(choice) and choice[j + 1] == y and not t.label[j + 1] and text[t.end[j]:t.start[j + 1]] == " ":
            j += 1
            if (LABELS[y], NOT_DIGIT.sub("", text[t.start[i]:t.end[j]]).lstrip("0")) in known:
                last = j
        if y:
            out.append(_trimmed(text, y, t.start[i], t.end[last]))
        i = last + 1
    return [s for s in out if s[1] < s[2]]


def _trimmed(text: str, kind: int, start: int, end: int) -> Span:
    while start < end and not (text[start].isalnum() or text[start] == "+"):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return LABELS[kind], start, end


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are
    ignored): numbers of base spans by kind, ``base_sha256``, and ``spans`` with
    what the field added.

    A NULL text is empty and has no spans. Repeated rows give repeated results.
    Offsets count code points, the end excluded.
    """
    field = field or fit(docs)
    carried = Carried(docs, ["doc_id"])
    held = carried.held

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = rows["t"].tolist()
            for a, b in chunks(texts):
                found = find(texts[a:b], field)
                out = rows.iloc[a:b][held]
                counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
                yield out.assign(**counts, base_sha256=[hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found],
                                 spans=[_joined(every) for _, every in found])

    made = docs.select(*carried.columns, docs["text"].alias("t")).mapInPandas(
        run, carried.ddl + ", n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return carried.back(made)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join((*out, text[at:]))


def mask(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All rows and columns of ``docs``, the personal data of ``text`` masked and
    ``n_chars`` (if there) recounted where the text changed. NULL stays NULL."""
    field = field or fit(docs)

    @F.pandas_udf("string")
    def changed(texts: pd.Series) -> pd.Series:
        """The masked text, NULL where nothing is to be masked."""
        rows, made = texts.tolist(), []
        for a, b in chunks(rows):
            made += [masked(t, every) if every else None for t, (_, every) in zip(rows[a:b], find(rows[a:b], field))]
        return pd.Series(made, dtype=object)

    # a generator's output is computed once, whatever is asked of it
    marked = docs.select("*", F.explode(F.array(F.struct(changed("text").alias("new")))).alias("_masked"))
    new = F.col("_masked.new")
    columns = {"text": F.coalesce(new, F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(new.isNotNull(), F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return marked.withColumns(columns).select(*docs.columns)
