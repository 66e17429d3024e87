"""Every opN_ query against its SQL or a brute-force version of what it must return."""

from __future__ import annotations

import hashlib
import math
import os
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from check import comparable, connect, oracle_rows

from vitaelake.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SPACE = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


@pytest.fixture(scope="module")
def labels(spark):
    rows = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    return {r.doc_id: r for r in rows}


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, expected = oracle_rows(db, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, expected)


def test_every_query_is_tested_here_or_has_sql():
    own = {"op1_line_dedup", "op2_lm_scoring", "op4_pii", "op6_quality_rules", "op7_quality_gam"}
    own |= {"op9_ring_sharding", "op10_mixing", "op13_repeats"}
    assert set(QUERIES) == own | set(ORACLE_SQL)


def test_line_classes(spark, docs):
    rows = result(spark, "op1_line_dedup")
    lines = {
        (d.doc_id, i): line.strip(" \t\n\x0b\f\r")
        for d in docs for i, line in enumerate((d.text or "").split("\n"))
    }
    lines = {place: line for place, line in lines.items() if line}
    assert {(r.doc_id, r.line) for r in rows} == lines.keys()
    classes = defaultdict(set)
    for r in rows:
        assert r.kept == ((r.doc_id, r.line) == (r.class_doc, r.class_line))
        classes[r.class_doc, r.class_line].add((r.doc_id, r.line))
    assert all(min(places) == first for first, places in classes.items())
    of = {place: first for first, places in classes.items() for place in places}
    by_text = defaultdict(set)
    for place, line in lines.items():
        by_text[line].add(of[place])
    assert all(len(found) == 1 for found in by_text.values())


def test_language_model(spark, docs):
    counts, total = Counter(), 0
    tokens = {d.doc_id: [*WORD.findall(lowered(d.text)), None] for d in docs}
    for d in docs:
        if fold(d.doc_id) != 1:
            counts.update(tokens[d.doc_id])
            total += len(tokens[d.doc_id])
    scale = total + 0.5 * (len(counts) + 1)
    rows = result(spark, "op2_lm_scoring")
    assert len(rows) == len(docs)
    gain = n_held = 0
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(r.doc_id) == 1, len(own), total)
        assert r.n_known == sum(t in counts for t in own)
        base = sum(math.log10((counts[t] + 0.5) / scale) for t in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
        if r.held_out:
            gain, n_held = gain + r.score - r.base_score, n_held + len(own)
    assert gain / n_held > 0.1  # decimal orders a word that the model is better than the base


def spans_by_scan(text):
    """Base spans by patterns that scan from every place on, kind by kind."""
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    )
    found = []
    for kind, (pattern, sound) in enumerate(kinds):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if sound(m.group())]
    return sorted(found)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_personal_data(spark, docs):
    names = ("email", "ip", "card", "phone")
    rows = {r.doc_id: r for r in result(spark, "op4_pii")}
    assert len(rows) == len(docs)
    for d in docs:
        base = spans_by_scan(d.text or "")
        r = rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        texts = [f"{names[k]}:{b}:{e}" for b, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(texts).encode()).hexdigest()
        assert set(texts) <= set(r.spans.split(","))| {""} or not texts


def test_quality_rules(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op6_quality_rules")}
    for d in docs:
        text, r = d.text or "", rows[d.doc_id]
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i : i + 8])] > 1:
                covered.update(range(i, i + 8))
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
        )
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_quality_classifier(spark, docs, labels):
    rows = result(spark, "op7_quality_gam")
    assert {r.doc_id for r in rows} == {d.doc_id for d in docs} and len(rows) == len(docs)
    right = held = 0
    for r in rows:
        assert r.held_out == (fold(r.doc_id) == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in labels:
            held, right = held + 1, right + (r.predicted == labels[r.doc_id].quality)
    assert held >= 10 and right / held >= 0.85


def test_sharding(spark, docs):
    rows = result(spark, "op9_ring_sharding")
    texts = {d.doc_id: (d.text or "").encode() for d in docs}
    shards = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None
        shards[r.shard].append(r.slot)
    assert len(rows) == len(docs) and set(shards) == set(range(16))
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    sizes = [len(slots) for slots in shards.values()]
    assert max(sizes) - min(sizes) <= 1


def test_mixing(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op10_mixing")}
    sizes, largest = Counter(), Counter()
    for d in docs:
        n = len(WORD.findall(d.text or ""))
        assert rows[d.doc_id].size == n
        sizes[d.source] += n
        largest[d.source] = max(largest[d.source], n)
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal, left = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in goal]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            goal |= share
            break
        for s in above:
            goal[s] = 2.0 * sizes[s]
        left -= sum(goal[s] for s in above)
    taken = Counter()
    for d in docs:
        r = rows[d.doc_id]
        assert r.source_size == sizes[d.source] and r.target == pytest.approx(goal[d.source])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
        taken[d.source] += r.taken
    # What stays open of a source when its fractions are paired is one document's.
    assert all(abs(taken[s] - goal[s]) <= 2 * largest[s] for s in names)
    again = {r.doc_id: r.taken for r in result(spark, "op10_mixing")}
    assert again == {k: r.taken for k, r in rows.items()}


_ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
from vitaelake.llm.queries import QUERIES
for name in sorted(QUERIES):
    print(name, QUERIES[name](spark, {sf!r}).count(), flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The driver alone knows where the package is; workers start in another folder."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = _ELSEWHERE.format(root=ROOT, sf=SF_DIR)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()] == sorted(QUERIES)
