from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vitaelake.config import EMAIL_PATTERN, LEADERSHIP, PHONE_PATTERN, SENIORITY, Lexicon
from vitaelake.functions.extract import extract_text
from vitaelake.functions.paths import category_of, resume_id_of
from vitaelake.functions.text import (
    clean_text,
    has_email,
    has_phone,
    html_text,
    is_unreadable,
    lexicon_score,
    snippet,
    term_hits,
    terms_can_overlap,
    word_count,
)


def evaluate(spark, values, *expressions, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    columns = [build(F.col("v")).alias(f"c{n}") for n, build in enumerate(expressions)]
    got = rows.select("i", *columns).orderBy("i").collect()
    return [r[1] if len(expressions) == 1 else tuple(r[1:]) for r in got]


def test_whitespace(spark):
    texts = ["a  b\n\nc ", " \n\t ", None, "x\x0by\r\n z", "a b", "one"]
    cleaned = lambda v: clean_text(v)
    assert evaluate(spark, texts, cleaned) == ["a b c", "", None, "x y z", "a b", "one"]
    counts = evaluate(spark, texts, lambda v: word_count(clean_text(v)))
    split = evaluate(spark, texts, lambda v: F.size(F.split(clean_text(v), r"\s+")))
    assert counts == split == [3, 1, None, 3, 1, 1]


@pytest.mark.parametrize("least", [1, 2, 5])
def test_unreadable_is_the_word_count_rule(spark, least):
    texts = [None, "", " \n\t ", "a", " a b", "a b c d", "\na  b\tc d e ", "w" * 5000, "a b c d e f"]
    verdicts = evaluate(spark, texts, lambda v: is_unreadable(v, least))
    assert verdicts == [len((t or "").split()) < least for t in texts]
    with pytest.raises(ValueError):
        is_unreadable(F.lit("a"), 0)


def test_default_lexicons(spark):
    texts = [
        "Led and managed; helped",
        "assisted, supported",
        "Senior Director, head of internship",
        "entry-level entry level",
        "misled handled",
        "éled ledé led",
        "led led led",
        "LED.MANAGED founded",
    ]
    got = evaluate(
        spark,
        texts,
        lambda v: lexicon_score(v, LEADERSHIP),
        lambda v: lexicon_score(v, SENIORITY),
    )
    assert got == [(1, 0), (-2, 0), (0, 3), (0, -2), (0, 0), (1, 0), (3, 0), (3, 0)]


def test_alternation_only_where_terms_cannot_overlap(spark):
    for side in (*vars(LEADERSHIP).values(), *vars(SENIORITY).values()):
        assert not terms_can_overlap(side)
    assert terms_can_overlap(["head of", "of state"])
    assert terms_can_overlap(["head", "head of"])
    assert not terms_can_overlap(["led", "director"])
    text = ["head of state head of head"]
    # Each term counts on its own: twice "head of", once "of state", 3 "head".
    assert evaluate(spark, text, lambda v: term_hits(v, ["head of", "of state", "head"])) == [6]
    assert evaluate(spark, text, lambda v: term_hits(v, ["head", "head"])) == [6]
    assert evaluate(spark, text, lambda v: term_hits(v, [])) == [0]
    assert evaluate(spark, ["a.c abc"], lambda v: term_hits(v, ["a.c"])) == [1]
    assert evaluate(spark, text, lambda v: lexicon_score(v, Lexicon(("state",), ()))) == [1]
    with pytest.raises(ValueError):
        term_hits(F.lit("a"), [""])


@pytest.mark.parametrize(
    "lexicon",
    [
        Lexicon(("head of", "head"), ("state",)),
        Lexicon(("head",), ("head of", "of")),
        Lexicon(("head", "of"), ("head",)),
        Lexicon((), ("of",)),
        Lexicon(("Head",), ()),
        Lexicon(("head", "of"), ("state", "no.thing")),
    ],
)
def test_score_is_the_difference_of_the_sides(spark, lexicon):
    texts = ["head of state head of head", "Head, of-of no.thing nothing", "", None]
    got = evaluate(
        spark,
        texts,
        lambda v: lexicon_score(v, lexicon),
        lambda v: term_hits(v, lexicon.plus) - term_hits(v, lexicon.minus),
    )
    plain = [
        None if t is None else sum(
            sign * len(re.findall(rf"\b{re.escape(term.lower())}\b", t.lower()))
            for sign, side in ((1, lexicon.plus), (-1, lexicon.minus))
            for term in side
        )
        for t in texts
    ]
    assert got == [(n, n) for n in plain]


def test_contacts(spark):
    texts = [
        "x a.b@c.org",
        "(506) 123-4567",
        "506.123.4567",
        "(506)  123-4567",
        "+506 8888-7777",
        "12345678901234",
        "a@b",
        "@c.org",
        "é@c.org",
        "-@c.org",
        "w" * 20000 + "@c.org",
        "w" * 20000,
    ]
    got = evaluate(spark, texts, has_email, has_phone)
    phones = [False, True, True, False, False, True] + [False] * 6
    assert got == [(bool(re.search(EMAIL_PATTERN, t)), p) for t, p in zip(texts, phones)]
    assert phones == [bool(re.search(PHONE_PATTERN, t)) for t in texts]


def test_snippet(spark):
    assert evaluate(spark, ["é" * 500, None, "ab"], snippet) == ["é" * 200, "", "ab"]


def test_paths(spark):
    paths = ["/x/HR/10.pdf", "/x/HR/10.PDF", "10.pdf", "/10.pdf", "file:/a/B-C/d e.pdf"]
    got = evaluate(spark, paths, resume_id_of, category_of)
    assert got == [("10", "HR"), ("", ""), ("10", ""), ("10", ""), ("d e", "B-C")]
    assert evaluate(spark, ["/x/HR/1.txt"], lambda v: category_of(v, "txt")) == ["HR"]


def test_html(spark):
    page = (
        "<html><head><style>p{}</style><SCRIPT x>var t='</p>';\n</SCRIPT ></head>"
        "<body><!-- no\n --><p>a&amp;lt;b&nbsp;c</p><b>&#39;d&quot;</b></body></html>"
    )
    assert evaluate(spark, [page, None], html_text) == ["a&lt;b c 'd\"", None]


def test_extraction_errors_become_null(spark):
    def extractor(content):
        if content == b"bad":
            raise RuntimeError("damaged")
        return content.decode()

    contents = [b"good", b"bad", None, b""]
    got = evaluate(spark, contents, lambda v: extract_text(v, extractor), kind="binary")
    assert got == ["good", None, None, ""]


def test_a_missing_parser_fails_the_job(spark):
    def extractor(content):
        raise ImportError("no parser")

    with pytest.raises(Exception, match="no parser"):
        evaluate(spark, [b"x"], lambda v: extract_text(v, extractor), kind="binary")
