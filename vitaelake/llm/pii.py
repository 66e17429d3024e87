"""Personal data: patterns, and a skip-chain conditional random field over tokens.

The patterns give the base spans. The field then labels every token that holds a
digit or an at sign (others carry no personal data by its features, so their label
is known): a token's own features, the label of the token before it, and long-range
factors between equal or similar tokens of the same document all have a say, and
loopy message passing brings the labels of a document into agreement. Tokens in base
spans are observed; others get a span when a label is all but certain. So a number
that is written out once and mangled elsewhere is found in both places.

The field is trained on base spans as labels, on at most ``max_docs`` documents with
such tokens, those of smallest id hash: a softmax over token features, transition
frequencies, and the log-odds of agreement of similar tokens. Repeated tokens are
tied to the one before them, not each to all, so work grows with the text.

NULL and empty texts have no spans. Positions are code points, ends exclusive.
Patterns are searched in time linear in the text. Repeated rows get equal spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import raw_text, summed_by

KINDS = ("email", "ip", "card", "phone")
MAX_DOCS = 5_000
CERTAIN = 0.95
ROUNDS = 8
CONTEXT_BUCKETS = 32

# The second pattern of a kind is tried where the last match ended: a match may
# begin there in the middle of a run, but elsewhere only at the start of one.
_EMAIL_REST = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP_REST = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
_EMAIL = (re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL_REST), re.compile(_EMAIL_REST))
_IP = (re.compile(r"(?<![0-9])" + _IP_REST), re.compile(_IP_REST))
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^ \t-\r]+")
_MARK = re.compile("[0-9@]")
_EDGE = re.compile(r"^[^0-9A-Za-z+]+|[^0-9A-Za-z]+$")

Span = tuple[int, int, int]  # begin, kind, end


def _runs(text: str, patterns: tuple[re.Pattern, re.Pattern]) -> Iterator[re.Match]:
    at = 0
    while True:
        found = patterns[1].match(text, at) or patterns[0].search(text, at)
        if found is None:
            return
        yield found
        at = found.end()


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by begin and then kind."""
    spans: list[Span] = []
    if "@" in text:
        spans += [(m.start(), 0, m.end()) for m in _runs(text, _EMAIL)]
    spans += [
        (m.start(), 1, m.end())
        for m in _runs(text, _IP)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))
    ]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


@dataclass
class _Chain:
    """Candidate tokens of one document."""

    begins: list[int]
    ends: list[int]
    features: np.ndarray
    adjacent: list[bool]
    skips: list[tuple[int, int]]
    observed: list[int]  # 0 other, 1 + kind; of tokens in base spans


def _shape(token: str, before: str) -> list[float]:
    n = max(len(token), 1)
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    out = [
        1.0, digits / n, letters / n, float(token.count("@") == 1), min(token.count("."), 4) / 4,
        float("@" in token and "." in token.rpartition("@")[2]), float(token.startswith("+")),
        float("(" in token and ")" in token), min(token.count("-"), 3) / 3,
        float(digits == 0), float(1 <= digits <= 3), float(4 <= digits <= 8), float(9 <= digits <= 11),
        float(12 <= digits <= 15), float(16 <= digits <= 19), float(digits > 19),
        float(token.count(".") == 3 and letters == 0), float(before.startswith("+")), float(")" in before),
        float(any(c.isdigit() for c in before)),
    ]
    context = [0.0] * CONTEXT_BUCKETS
    word = re.sub(r"[^a-z]", "", before.lower())
    if word:
        context[zlib.crc32(word.encode()) % CONTEXT_BUCKETS] = 1.0
    return out + context


def _keys(token: str) -> list[str]:
    """What similar tokens share: the token without its edges, and its digits."""
    bare = _EDGE.sub("", token).lower()
    digits = "".join(c for c in token if "0" <= c <= "9")
    return [f"t{bare}"] * (len(bare) >= 4) + [f"d{digits}"] * (len(digits) >= 7)


def _chain(text: str, spans: list[Span]) -> _Chain:
    chain = _Chain([], [], np.empty((0, 0)), [], [], [])
    rows, seen, at = [], {}, 0
    for m in _TOKEN.finditer(text):
        if not _MARK.search(m.group()):
            continue
        token, number = m.group(), len(rows)
        before = re.search(r"([^ \t-\r]{1,40})[ \t-\r]$", text[max(0, m.start() - 41) : m.start()])
        rows.append(_shape(token, before.group(1) if before else ""))
        chain.adjacent.append(bool(chain.ends) and m.start() - chain.ends[-1] == 1)
        chain.begins.append(m.start())
        chain.ends.append(m.end())
        while at < len(spans) and spans[at][2] <= m.start():
            at += 1
        own = next((1 + k for b, k, e in spans[at : at + 4] if b < m.end() and e > m.start()), 0)
        chain.observed.append(own)
        for key in _keys(token):
            if key in seen:
                chain.skips.append((seen[key], number))
            seen[key] = number
    chain.features = np.array(rows)
    chain.skips = sorted(set(chain.skips))
    return chain


@dataclass
class Field:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


_LABELS = 1 + len(KINDS)


def fit(chains: list[_Chain], steps: int = 300) -> Field:
    """Piecewise training: unary softmax, transitions and agreement, each on its own."""
    width = len(_shape("", ""))
    weights = np.zeros((width, _LABELS))
    transitions, together = np.ones((_LABELS, _LABELS)), np.ones((_LABELS, _LABELS))
    alone = np.ones(_LABELS)
    for c in chains:
        for i, label in enumerate(c.observed):
            alone[label] += 1
            if c.adjacent[i]:
                transitions[c.observed[i - 1], label] += 1
        for i, j in c.skips:
            together[c.observed[i], c.observed[j]] += 1
    share = alone / alone.sum()
    if chains:
        x = np.concatenate([c.features for c in chains])
        y = np.eye(_LABELS)[np.concatenate([c.observed for c in chains])]
        for _ in range(steps):
            z = x @ weights
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights += 2.0 * (x.T @ (y - p) / len(x) - 1e-4 * weights)

    def odds(counts: np.ndarray) -> np.ndarray:
        return np.log(counts / counts.sum()) - np.log(np.outer(share, share))

    both = together + together.T
    return Field(weights, np.clip(odds(transitions), -3, 3), np.clip(odds(both), -4, 4))


def marginals(chain: _Chain, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every token, by loopy sum-product messages."""
    n = len(chain.begins)
    own = chain.features @ field.unary
    for i, label in enumerate(chain.observed):
        if label:
            own[i] = -50.0
            own[i, label] = 0.0
    edges = [(i - 1, i, field.chain) for i in range(1, n) if chain.adjacent[i]]
    edges += [(i, j, field.skip) for i, j in chain.skips]
    if edges:
        source = np.array([i for i, _, _ in edges] + [j for _, j, _ in edges])
        target = np.array([j for _, j, _ in edges] + [i for i, _, _ in edges])
        factor = np.array([f for _, _, f in edges] + [f.T for _, _, f in edges])
        half = len(edges)
        opposite = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        messages = np.zeros((2 * half, _LABELS))
        for _ in range(rounds):
            belief = own.copy()
            np.add.at(belief, target, messages)
            outgoing = (belief[source] - messages[opposite])[:, :, None] + factor
            top = outgoing.max(axis=1)
            fresh = top + np.log(np.exp(outgoing - top[:, None, :]).sum(axis=1))
            fresh -= fresh.max(axis=1, keepdims=True)
            messages = 0.5 * messages + 0.5 * fresh
        np.add.at(own, target, messages)
    p = np.exp(own - own.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """Spans of unobserved tokens whose label is all but certain."""
    chain = _chain(text, spans)
    if not chain.begins or all(chain.observed):
        return []
    out: list[Span] = []
    p = marginals(chain, field)
    taken = sorted((b, e) for b, _, e in spans)
    for i in np.flatnonzero((p[:, 1:].max(axis=1) >= CERTAIN) & (np.array(chain.observed) == 0)):
        begin, end = chain.begins[i], chain.ends[i]
        token = text[begin:end]
        lead = re.match(r"[^0-9A-Za-z+]*", token).end()
        trail = len(token) - len(re.sub(r"[^0-9A-Za-z]+$", "", token))
        begin, end = begin + lead, end - trail
        if begin < end and not any(b < end and e > begin for b, e in taken):
            out.append((begin, int(p[i, 1:].argmax()), end))
    return out


_FLAGS = np.zeros(256, dtype=np.int64)
_FLAGS[[*range(48, 58), ord("@")]] = 1


def _candidates(column: pa.Array) -> np.ndarray:
    """Rows whose text holds a digit or an at sign; the others have no spans."""
    data, bounds = raw_text(column)
    out = np.zeros(len(column), dtype=bool)
    for lo in range(0, len(column), 256):
        cut = bounds[lo : lo + 257]
        out[lo : lo + 256] = summed_by(_FLAGS[data[cut[0] : cut[-1]]], cut - cut[0]) > 0
    return np.flatnonzero(out)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", max_docs: int = MAX_DOCS) -> Field:
    """Fit the field on the documents of smallest id hash that have candidates."""
    some = docs.filter(F.col(text).rlike("[0-9@]")).select(F.xxhash64(key, text).alias("h"), text)
    chosen = some.select("h").orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    if chosen is None:
        return fit([])

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                c = _chain(content, base_spans(content))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]) for x in (
                        c.features.astype(np.float32).tobytes(), np.array(c.adjacent, np.int8).tobytes(),
                        np.array(c.skips, np.int32).tobytes(), np.array(c.observed, np.int8).tobytes(),
                    )],
                    names=["features", "adjacent", "skips", "observed"],
                )

    rows = some.filter(F.col("h") <= chosen).orderBy("h").limit(max_docs).select(text)
    width = len(_shape("", ""))
    out = []
    schema = "features binary, adjacent binary, skips binary, observed binary"
    for r in rows.mapInArrow(chains, schema).collect():
        skips = np.frombuffer(r.skips, np.int32).reshape(-1, 2)
        out.append(
            _Chain([], [], np.frombuffer(r.features, np.float32).reshape(-1, width).astype(float),
                   [bool(x) for x in np.frombuffer(r.adjacent, np.int8)],
                   [(int(a), int(b)) for a, b in skips], list(np.frombuffer(r.observed, np.int8)))
        )
    return fit(out)


_SPAN_LIST = pa.list_(pa.struct([("begin", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
_SPAN_TYPE = "array<struct<begin: bigint, kind: string, end: bigint>>"


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base_spans and spans (all), each by begin and then kind, of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(spans: list[Span]) -> list[dict]:
        return [{"begin": b, "kind": KINDS[k], "end": e} for b, k, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base: list[list] = [[] for _ in range(batch.num_rows)]
            full: list[list] = [[] for _ in range(batch.num_rows)]
            for i in _candidates(batch.column(1)):
                content = batch.column(1)[int(i)].as_py()
                spans = base_spans(content)
                base[i] = rows(spans)
                full[i] = rows(sorted(spans + added_spans(content, spans, field)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, _SPAN_LIST), pa.array(full, _SPAN_LIST)],
                names=["key", "base_spans", "spans"],
            )

    out = docs.select(F.col(key), F.col(text)).mapInArrow(
        run, f"key {kind}, base_spans {_SPAN_TYPE}, spans {_SPAN_TYPE}"
    )
    return out.withColumnRenamed("key", key)
