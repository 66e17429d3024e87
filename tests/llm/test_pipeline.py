"""Every stage of the pipeline on odd rows, and the whole of it."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "llr string, kept string, n_words string, hit_spans string, items string, size string, "
    "shard string, id string, first string, spans string"
)
CLASH = tuple("abcdefghij")
ITEM = "one benchmark question asks which river runs through the old town and into the sea"


def prose(draw: random.Random, n: int) -> str:
    names = [f"{a}{b}" for a in ("la", "mi", "to", "re", "su", "ko") for b in ("ne", "ra", "vi", "do", "pe")]
    out = [draw.choice(names) + draw.choice(names) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(out))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    texts = {i: prose(draw, draw.randint(40, 160)) for i in range(1, 61)}
    texts[70] = texts[5]
    texts[71] = texts[6] + " Addendum."
    texts[72] = prose(draw, 60) + " " + ITEM + " " + prose(draw, 30)
    texts[73] = ITEM
    texts[74] = "###$$ %% | & # $ " * 40
    texts[75] = "buy now " * 60
    texts[76], texts[77], texts[78] = None, "", "few words only"
    texts[79] = prose(draw, 30_000)
    out = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), *CLASH) for i, t in texts.items()]
    out.append(out[10])  # the same row again
    out.append((out[11][0], prose(draw, 90), *out[11][2:]))  # the same id, other content
    out.append((None, prose(draw, 90), *out[12][2:]))
    draw.shuffle(out)
    return out


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i not in (74, 75)), 0) for i in range(1, 80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, ITEM), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def as_tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("stage", pipeline.STAGES, ids=lambda s: s[0])
def test_a_stage_takes_an_empty_table(spark, folder, stage):
    empty = documents(spark, folder).limit(0)
    out = stage[1](spark, empty, folder)
    assert out.count() == 0
    if stage[0] != "sharding":
        assert out.columns == empty.columns


def test_quality_drops_what_it_rejects_and_nothing_else(spark, folder, rows):
    kept = pipeline.quality(spark, documents(spark, folder), folder)
    assert kept.columns == documents(spark, folder).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert not {74, 75, 76, 77, 78, 73} & ids.keys()
    clean = Counter(r[0] for r in rows if len((r[1] or "").split()) >= 40 and r[0] not in (74, 75))
    assert sum((ids & clean).values()) >= 0.95 * sum(clean.values())
    assert set(as_tuples(kept)) <= set(rows)


def test_near_duplicates_keep_one_of_each_group(spark, folder, rows):
    kept = pipeline.near_duplicates(spark, documents(spark, folder), folder)
    found = as_tuples(kept)
    assert len(found) == len(set(found)) and set(found) <= set(rows)
    # A copy, a near copy, the row that was there twice; texts without words are no copies.
    assert sorted(set(rows) - set(found), key=repr) == sorted(
        {r for r in rows if r[0] in (70, 71)}, key=repr
    )


def test_decontamination_cuts_passages(spark, folder, rows):
    clean = pipeline.decontaminate(spark, documents(spark, folder), folder)
    assert clean.columns == documents(spark, folder).columns
    found = {r.doc_id: r for r in clean.collect() if r.doc_id in (72, 73)}
    assert set(found) == {72} and "river" not in found[72].text
    assert found[72].n_chars == len(found[72].text)
    whole = next(r[1] for r in rows if r[0] == 72)
    assert re.sub(r"\s+", " ", found[72].text) == re.sub(r"\s+", " ", whole.replace(ITEM, ""))
    others = [r for r in as_tuples(clean) if r[0] != 72]
    assert others == sorted((r for r in rows if r[0] not in (72, 73)), key=repr)


def test_mixing_repeats_rows_to_targets(spark, folder, rows):
    docs = documents(spark, folder)
    mixed = pipeline.mix(spark, docs, folder)
    assert mixed.columns == docs.columns
    found, given = Counter(map(tuple, mixed.collect())), Counter(rows)
    assert found.keys() <= given.keys()
    assert all(n <= 2 * given[row] for row, n in found.items())
    assert found == Counter(map(tuple, pipeline.mix(spark, docs, folder).collect()))
    words, largest, taken = Counter(), Counter(), Counter()
    for row, n in given.items():
        size = len((row[1] or "").split())
        words[row[3]] += n * size
        largest[row[3]] = max(largest[row[3]], size)
        taken[row[3]] += found[row] * size
    # s0 weighs 5, s1 2, s2 1 and NULL 5: none may take more than twice its words.
    assert all(taken[s] <= 2 * words[s] for s in words)
    assert abs(sum(taken.values()) - 1.5 * sum(words.values())) <= 2 * sum(largest.values())


def test_sharding_numbers_all_rows(spark, folder, rows):
    found = pipeline.shard(spark, documents(spark, folder), folder).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_the_whole_run(spark, folder, rows):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "decontamination", "mixing", "sharding"]
    found = pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in found}
    assert not ids & {70, 71, 73, 74, 75, 76, 77, 78}
    assert len(ids) >= 0.5 * len({r[0] for r in rows})
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
