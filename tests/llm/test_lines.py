"""Line dedup against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vitaelake.llm import line_dedup
from vitaelake.sources.staging import stage


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randint(0, len(out)), rng.random()
        if kind < 0.4 and at < len(out):
            out[at] = rng.choice("abé")
        elif kind < 0.7 and at < len(out):
            del out[at]
        else:
            out.insert(at, rng.choice("abé"))
    return "".join(out)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_distance(spark, most):
    rng = random.Random(most)
    pairs = []
    for _ in range(200):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        pairs.append((a, mutated(rng, a, rng.randint(0, 3))))
    column = line_dedup.edit_distance(F.col("a"), F.col("b"), most).alias("d")
    for row in spark.createDataFrame(pairs, "a string, b string").select("a", "b", column).collect():
        assert min(row.d, most + 1) == min(distance(row.a, row.b), most + 1), row


def classes(docs: list[tuple[int, str | None]]) -> dict:
    lines = {}
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\r\x0b\x0c"):
                lines[doc, number] = line.strip(" \t\n\r\x0b\x0c")
    parent = {line: line for line in lines.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(parent)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if min(len(a), len(b)) >= line_dedup.MIN_CHARS and abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    first = {}
    for place in sorted(lines):
        first.setdefault(root(lines[place]), place)
    return {place: first[root(line)] for place, line in lines.items()}


def test_classes_with_crowded_entries(spark):
    """A template with more fillings than an entry may hold, and longer ones."""
    rng = random.Random(5)
    bodies = [f"item number {n} of this shop" for n in range(100, 190)]
    bodies += [f"item number {n} of this shop" for n in (1000, 1100, 1890, 18, 5)]
    bodies += [mutated(rng, "a quite different line of text", rng.randint(0, 2)) for _ in range(30)]
    bodies += ["of", "to", "  padded line here\t", "padded line here", "", " "]
    docs = [(i, b + ("\nshared line of all\n" if i % 3 == 0 else "")) for i, b in enumerate(bodies)]
    docs += [(1000, None), (1001, ""), (1002, "one\n\none\ntwo")]
    rows = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    expected = classes(docs)
    assert {(r.doc_id, r.line): (r.class_doc, r.class_line) for r in rows} == expected
    assert all(r.kept == ((r.doc_id, r.line) == (r.class_doc, r.class_line)) for r in rows)


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id long, text string, line int, kept string"
    empty = line_dedup.dedup_lines(spark.createDataFrame([], schema))
    assert empty.columns == ["doc_id", "line", "class_doc", "class_line", "kept"]
    assert empty.count() == 0
    docs = [(None, "some line of text", 1, "x"), (3, "some line of text", 1, "x"), (3, "some line of text", 1, "x")]
    rows = line_dedup.dedup_lines(spark.createDataFrame(docs, schema)).collect()
    assert sorted((r.doc_id is None, r.kept) for r in rows) == [(False, False), (False, False), (True, True)]


def allowed(edits, n: int) -> int:
    return max((k for length, k in edits if n >= length), default=0)


def template(rng: random.Random, n: int, spots: int) -> list[str]:
    """Lines of one text that differ in a few places."""
    text = [rng.choice("abcdefgh ") for _ in range(n)]
    out = []
    for _ in range(60):
        line = list(text)
        for at in (3, n // 2, n - 5)[:spots]:
            line[at] = rng.choice("0123456789")
        out.append(mutated(rng, "".join(line), rng.randint(0, 2)).strip())
    return out


@pytest.mark.parametrize(
    "crowded, edits", [(64, line_dedup.EDITS), (64, ((0, 1), (24, 2), (28, 3))), (12, ((0, 1), (24, 2)))]
)
def test_links_of_more_edits(spark, monkeypatch, edits, crowded):
    """All pairs within the edits, in calm entries and in crowded ones."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    monkeypatch.setattr(line_dedup, "CROWDED_TIMES", 1)
    rng = random.Random(7)
    sizes = (14, 28) if crowded < 64 else (20, 28, 70)
    texts = {t for n in sizes for t in template(rng, n, 2)[:40]}
    texts |= {"copyright 2024-01-01 of the shop, all rights reserved, do not copy any of this text",
              "copyright 2024-01-19 of the shop, all rights reserved, do not copy any of this text"}
    texts = sorted(t for t in texts if len(t) >= line_dedup.MIN_CHARS)
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    expected = set()
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            k = allowed(edits, min(len(a), len(texts[j])))
            if abs(len(a) - len(texts[j])) <= k and distance(a, texts[j]) <= k:
                expected.add((i, j))
    found = {(r.a, r.b) for r in line_dedup.links(lines, edits).collect()}
    assert found <= expected

    def classes_of(pairs):
        parent = list(range(len(texts)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = {}
        for x in range(len(texts)):
            groups.setdefault(root(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    assert classes_of(found) == classes_of(expected)
    if crowded == 64:
        assert found == expected


@pytest.mark.parametrize("crowded, edits", [(64, line_dedup.EDITS), (64, ((0, 1), (24, 2), (28, 3))), (12, ((0, 1), (24, 2)))])
def test_class_links_make_the_same_classes(spark, monkeypatch, crowded, edits):
    """Fewer links than there are, but the same classes, for lines of up to 300 characters too."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    monkeypatch.setattr(line_dedup, "CROWDED_TIMES", 1)
    rng = random.Random(11)
    texts = {t for n in (20, 30, 70, 300) for t in template(rng, n, 1)[:25]}
    original = "a line that was copied again and again, and each time a little changed"
    texts |= {mutated(rng, original, rng.randint(0, 2)).strip() for _ in range(60)} | {original}
    texts = sorted(t for t in texts if len(t) >= line_dedup.MIN_CHARS)
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    expected = set()
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            k = allowed(edits, min(len(a), len(texts[j])))
            if abs(len(a) - len(texts[j])) <= k and distance(a, texts[j]) <= k:
                expected.add((i, j))
    found = {(r.a, r.b) for r in line_dedup.class_links(lines, edits).collect()}
    assert found <= expected

    def classes_of(pairs):
        name = list(range(len(texts)))
        for a, b in pairs:
            old, new = max(name[a], name[b]), min(name[a], name[b])
            name = [new if x == old else x for x in name]
        return name

    assert classes_of(found) == classes_of(expected)
    if crowded == 64:
        assert len(found) < len(expected)


def test_lines_that_share_no_entry_are_not_kept_again(spark, monkeypatch):
    """Marks and a second copy of the text are for lines that may be linked."""
    staged = {}

    def noted(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(line_dedup, "stage", noted)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(100)) for _ in range(60)]
    texts += [texts[7][:50] + "x" + texts[7][50:], texts[9][:-1] + "y"]
    found = line_dedup.links(spark.createDataFrame(list(enumerate(texts)), "id long, content string"))
    assert {(r.a, r.b) for r in found.collect()} == {(7, 60), (9, 61)}
    assert {r.id for r in staged["marked-lines"].collect()} == {7, 9, 60, 61}
    assert "mark_0" not in staged["line-entries"].columns


def inserted(rng: random.Random, text: str, word: str) -> str:
    at = rng.randint(1, len(text) - 1)
    return text[:at] + word + text[at:]


@pytest.mark.parametrize("edits", [line_dedup.EDITS, ((0, 2),), ((0, 2), (72, 3))])
def test_links_of_busy_entries(spark, monkeypatch, edits):
    """All pairs of lines that meet by their rarest passages, whatever differs and wherever."""
    monkeypatch.setattr(line_dedup, "CROWDED", 3)
    monkeypatch.setattr(line_dedup, "CROWDED_TIMES", 10_000)
    rng = random.Random(13)
    texts = set()
    for n in (66, 72, 300):
        base = "".join(rng.choice("abcdefgh ") for _ in range(n)).strip()
        repeated = ("is on he. " * 40)[: n - 1] + "x"
        for text in (base, repeated):
            texts |= {text, "zz" + text[2:], text[:-2] + "zz", text[:-1], text[1:] + "q", text[4:] + text[:4]}
            texts |= {mutated(rng, text, rng.randint(1, 4)).strip() for _ in range(12)}
            texts |= {inserted(rng, text, rng.choice(("kpq", "zé", "wvxy"))) for _ in range(8)}
    texts = sorted(t for t in texts if len(t) >= 64)
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    expected = set()
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            k = allowed(edits, min(len(a), len(texts[j])))
            if abs(len(a) - len(texts[j])) <= k and distance(a, texts[j]) <= k:
                expected.add((i, j))
    staged = []

    def noted(df, name):
        staged.append(name)
        return stage(df, name)

    monkeypatch.setattr(line_dedup, "stage", noted)
    assert {(r.a, r.b) for r in line_dedup.links(lines, edits).collect()} == expected
    assert "rare-lines" in staged


def test_busy_entries_make_few_pairs(spark, monkeypatch):
    """Lines of a template that are no near copies of each other are not all paired."""
    pairs = []

    def noted(df, name):
        out = stage(df, name)
        if name == "line-pairs":
            pairs.append(out)
        return out

    monkeypatch.setattr(line_dedup, "stage", noted)
    rng = random.Random(17)
    base = "".join(rng.choice("abcdefgh ") for _ in range(300)).strip()
    texts = [inserted(rng, base, "".join(rng.choice("jkpqvwxyz") for _ in range(4))) for _ in range(160)]
    texts += [texts[5] + "x", "y" + texts[8]]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    found = {(r.a, r.b) for r in line_dedup.class_links(lines).collect()}
    assert {(5, 160), (8, 161)} <= found
    assert pairs[0].count() < 30 * len(texts)
