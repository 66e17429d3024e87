"""Lexical search, phrases and repeated passages against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitaelake.llm import lexical_search, phrases, queries, repeats
from vitaelake.sources import staging

SCHEMA = (
    "doc_id long, text string, lang string, n long, terms string, row string, spans string, "
    "content string, id string, score string, words string"
)


def rows_of(texts, langs=("en", "fr", None)):
    """Texts with ids in falling order, and columns whose names the operators use too."""
    clash = (7, "t", "r", "s", "c", "i", "x", "w")
    return [(1000 - i, text, langs[i % len(langs)], *clash) for i, text in enumerate(texts)]


def some_texts(seed: int, n: int = 90) -> list:
    draw = random.Random(seed)
    names = [f"w{i}" for i in range(30)] + ["été", "ÜBER", "The", "the", "x\x01y"]
    weights = [1 / (i + 1) for i in range(len(names))]
    texts = []
    for _ in range(n):
        words = draw.choices(names, weights, k=draw.randint(0, 120))
        texts.append("".join(w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for w in words))
    texts += [None, "", " \t\n", "the", texts[3], texts[3], texts[5], "long the " * 9000]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = rows_of(some_texts(3))
    rows.append((None, "the w1 w2 w3 no id", "en", *rows[0][3:]))
    rows.append(rows[4])  # the same row again
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def best_documents(docs, items, k):
    counted = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(TERM.findall(lowered(text)))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (1, "the W1 w29"), (2, "w3 w4 w5 été nowhere"), (3, None), (4, "..."), (5, "über"), (None, "w7 w8"),
    (2, "w28 w3"), (6, " ".join(f"w{i}" for i in range(30))), (7, "nowhere to be found"), (8, "long"),
]


@pytest.mark.parametrize("leaf, block, trees", [(32, 1 << 20, 4096), (2, 7, 16), (1, 1 << 20, 4096)])
def test_search_equals_brute_force(spark, docs, monkeypatch, leaf, block, trees):
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "TREE_DOCS", trees)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = lexical_search.search(docs, items, k=4, block_terms=block)
    assert found.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == best_documents(texts, ITEMS, 4)


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_a_tree_leaves_subtrees_out(monkeypatch):
    rng = np.random.default_rng(1)
    n, sizes = 2000, rng.integers(1, 30, 2000)
    first = np.concatenate([[0], np.cumsum(sizes)])
    ranks = np.concatenate([np.sort(rng.choice(60, s, replace=False)) for s in sizes])
    tf = rng.integers(1, 5, len(ranks))
    m = rng.integers(10, 400, n)
    tree = lexical_search._Tree(np.arange(n), m, first, ranks, tf)
    weights = np.zeros(60, dtype=np.int64)
    weights[[3, 20, 55]] = [10, 4000, 9000]
    gains = lexical_search._gain(tf, np.repeat(m, sizes)) * weights[ranks]
    scores = np.add.reduceat(gains, first[:-1])
    order = np.lexsort((np.arange(n), -scores))[:10]
    visited = []
    spans = tree.spans

    class Watched(list):
        def __getitem__(self, node):
            visited.append(node)
            return spans[node]

    tree.spans = Watched(spans)
    none = np.empty(0, dtype=np.int64)
    found = tree.search(weights, (none, none), 10)
    assert found[1].tolist() == order.tolist() and found[0].tolist() == scores[order].tolist()
    leaves = sum(not c for c in tree.children)
    assert len(visited) < leaves
    for node, children in enumerate(tree.children):  # a parent covers its children
        if children:
            assert spans[node] == (spans[children[0]][0], spans[children[-1]][1])


# Phrases


def mined(rows, min_count, top, inside=80):
    runs = defaultdict(Counter)
    n = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    runs[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in runs.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for p, a in some.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    q = p[i : i + size]
                    longest[q] = max(longest[q], a)
        scored = []
        for p, a in some.items():
            if 100 * longest[p] >= inside * a:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("word_block, held", [(1 << 23, 1 << 22), (11, 64)])
def test_phrases_equal_brute_force(docs, monkeypatch, word_block, held):
    monkeypatch.setattr(phrases, "HELD_RUNS", held)
    monkeypatch.setattr(phrases, "HELD_ENTRIES", 8 * held)
    monkeypatch.setattr(phrases, "HELD_WORDS", held)
    found = phrases.mine_phrases(docs, min_count=5, top=40, word_block=word_block)
    assert sorted(map(tuple, found.collect())) == mined(
        [(r.text, r.lang) for r in docs.collect()], 5, 40
    )


def test_phrases_by_shuffled_counts(docs, monkeypatch):
    expected = sorted(map(tuple, phrases.mine_phrases(docs, min_count=9, top=9).collect()))
    monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", 0)
    assert sorted(map(tuple, phrases.mine_phrases(docs, min_count=9, top=9).collect())) == expected


def test_phrases_of_nothing(spark, empty):
    assert phrases.mine_phrases(empty).count() == 0
    few = spark.createDataFrame(rows_of(["a b", None]), SCHEMA)
    assert phrases.mine_phrases(few).count() == 0
    with pytest.raises(ValueError):
        phrases.mine_phrases(few, longest=5)


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 17), (2, 32), (3, 5), (3, 32), (4, 3), (4, 21), (4, 32)])
def test_quotient_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(bits)
    words = rng.integers(1, min(2**bits, 40), (500, n), dtype=np.uint64, endpoint=bits < 6)
    words %= np.uint64(1 << bits)
    packing = phrases.Packing(n, bits, 8)
    high = (words[:, 0] << np.uint64(bits)) | words[:, 1]
    low = {2: None, 3: words[:, 2] if n > 2 else None}.get(n)
    if n == 4:
        low = (words[:, 2] << np.uint64(bits)) | words[:, 3]
    one = phrases.QuotientFilter(packing, *packing.permute(high, low), None)
    two = phrases.QuotientFilter.merged(packing, [one, one])
    rows = two.rows()
    counted = Counter()
    for bucket in range(rows.num_rows):
        table = rows.slice(bucket, 1)
        part = phrases.QuotientFilter.of_rows(packing, table)
        back = packing.words(*packing.invert(part.high, part.low))
        for run, count in zip(map(tuple, back.astype(np.uint32).tolist()), part.counts.tolist()):
            counted[run] += count
    assert counted == Counter({k: 2 * v for k, v in Counter(map(tuple, words.tolist())).items()})


# Repeated passages


def kept_bytes(rows, window):
    """(id, text) -> removed spans and kept bytes, by all windows of all smaller ids."""
    held = defaultdict(set)
    for key, text in rows:
        content = (text or "").encode()
        for i in range(len(content) - window + 1):
            held[content[i : i + window]].add(key if key is not None else math.inf)
    least = {w: min(keys) for w, keys in held.items()}
    out = []
    for key, text in rows:
        content = (text or "").encode()
        covered = np.zeros(len(content), dtype=bool)
        for i in range(len(content) - window + 1 if key is not None else 0):
            if least[content[i : i + window]] < key:
                covered[i : i + window] = True
        turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).tolist()
        kept = bytes(b for b, c in zip(content, covered) if not c)
        out.append((key, len(content), list(zip(turns[::2], turns[1::2])), kept))
    return sorted(out, key=repr)


def passages(seed: int) -> list:
    draw = random.Random(seed)
    letters = "abcdefgh éß\n"
    new = lambda n: "".join(draw.choice(letters) for _ in range(n))
    shared = [new(n) for n in (20, 49, 50, 51, 76, 77, 130, 400)]
    texts = [None, "", "x" * 49, "y" * 50, "y" * 51, "z" * 300, "z" * 120, "ab" * 200, "ab" * 90]
    for i in range(60):
        parts = [new(draw.randint(0, 60)) for _ in range(3)]
        parts.insert(1, draw.choice(shared))
        if i % 3 == 0:
            parts.append(draw.choice(shared)[: draw.randint(10, 90)])
        texts.append("".join(parts))
    texts += [texts[12], texts[12], texts[13] + "!", texts[13][1:], "".join(shared) * 2]
    return texts


@pytest.mark.parametrize(
    "window, gram, settings",
    [
        (50, 24, {}),
        (50, 24, {"HOT_KINDS": 0, "HOT_COPIES": 1, "HELD": 50}),
        (20, 8, {"PIECE_BYTES": 64, "HOT_COPIES": 2}),
        (50, 24, {"broadcast": False}),
    ],
)
def test_repeats_equal_brute_force(spark, monkeypatch, window, gram, settings):
    for name, value in settings.items():
        if name == "broadcast":
            monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", 0)
        else:
            monkeypatch.setattr(repeats, name, value)
    rows = rows_of(passages(7))
    rows += [(None, rows[20][1], *rows[0][2:]), rows[21], (rows[22][0], rows[23][1], *rows[0][2:])]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = repeats.remove_repeats(docs, window=window, gram=gram)
    got = [
        (r.row.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in found.collect()
    ]
    assert sorted(got, key=repr) == kept_bytes([(r[0], r[1]) for r in rows], window)
    assert set(found.schema["row"].dataType.names) == set(docs.columns) - {"text"}


def test_repeats_of_nothing(spark, empty):
    assert repeats.remove_repeats(empty).count() == 0
    alone = spark.createDataFrame(rows_of(["only one text, and quite a long one at that" * 3]), SCHEMA)
    assert repeats.remove_repeats(alone).select(F.size("removed")).first()[0] == 0


def test_the_query_of_repeats(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = [
        (key, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for key, n, spans, kept in kept_bytes([tuple(r) for r in rows], 50)
    ]
    found = queries.QUERIES["op13_repeats"](spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=repr) == expected
