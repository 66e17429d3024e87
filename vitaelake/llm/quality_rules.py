"""Quality rules by the likelihood ratio of hashed n-grams, in DataFrame functions only.

Two multinomials over hashed n-grams are counted: one over trusted texts, one over
the whole corpus. A document's score is the mean log-likelihood ratio of its
n-grams, and every document below a fixed threshold is rejected. The n-grams are
words, and pairs of neighbouring word shapes (runs of small letters, capitals and
digits each become one sign), which also tell tables, shouting and symbol noise
from prose where the words themselves are rare.

The weights have a fixed number of buckets, whatever the corpus, and reach the
tasks as one array. No text is shuffled unless the list of trusted ids is too
large to broadcast. Documents without words score 0. NULL texts are empty; a NULL
id is never trusted; repeated rows count each time; where there are no trusted
texts, all ratios are those of the smoothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.sources.staging import sized, stage

BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.1

SPACE = r"[ \t-\x0D]+"
_SPACES = " \t\n\x0B\f\r"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8


def words(text: Column) -> Column:
    """Runs of anything but ASCII whitespace; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _shapes(text: Column) -> Column:
    small = F.regexp_replace(F.coalesce(text, F.lit("")), r"[a-z\p{Ll}]+", "a")
    capital = F.regexp_replace(small, r"[A-Z\p{Lu}]+", "A")
    return words(F.regexp_replace(capital, "[0-9]+", "0"))


def _hashed(array: Column) -> Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def _joined(hashes: Column, shift: int) -> Column:
    """Hash of each element with the one ``shift`` later.

    The array is bound by a transform, so that it is computed once and not in each of
    the places that name it.
    """

    def pairs(h: Column) -> Column:
        left = F.greatest(F.size(h) - shift, F.lit(0))
        before, after = F.slice(h, F.lit(1), left), F.slice(h, F.lit(shift + 1), left)
        return F.zip_with(before, after, lambda a, b: F.xxhash64(a, b))

    return F.transform(F.array(hashes), pairs)[0]


def _buckets(hashes: Column) -> Column:
    return F.transform(hashes, lambda h: h.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int"))


def _with_grams(docs: DataFrame, text: str) -> DataFrame:
    """Hashes of the words and shapes, and of the shape pairs."""
    hashed = docs.withColumns(
        {"__words": _hashed(words(F.col(text))), "__shapes": _hashed(_shapes(F.col(text)))}
    )
    return hashed.withColumn("__pairs", _joined(F.col("__shapes"), 1))


def weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, weight) of every bucket; ``trusted`` holds the ids of trusted texts."""
    ids = sized(stage(trusted.select(F.col(key).alias("__trusted")).dropna().distinct(), "trusted"))
    marked = docs.select(key, text).join(ids, F.col(key) == F.col("__trusted"), "left")
    grams = _with_grams(marked, text).select(
        F.col("__trusted").isNotNull().cast("long").alias("target"),
        F.explode(_buckets(F.concat("__words", "__pairs"))).alias("bucket"),
    )
    counted = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("target").alias("target")
    )
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counted, "bucket", "left").na.fill(0, ["raw", "target"])
    total = stage(full, "gram-counts")
    sums = total.agg(F.sum("raw"), F.sum("target")).first()

    def log_share(count: str, whole: int) -> Column:
        return F.log((F.col(count) + SMOOTHING) / (whole + SMOOTHING * BUCKETS))

    ratio = log_share("target", sums[1]) - log_share("raw", sums[0])
    return total.select("bucket", F.round(ratio, 6).alias("weight"))


def with_score(docs: DataFrame, weighted: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__words`` (hashes) and ``llr``, the mean log-likelihood ratio."""
    entries = F.array_sort(F.collect_list(F.struct("bucket", "weight")))
    array = weighted.agg(F.transform(entries, lambda e: e["weight"]).alias("w")).scalar()
    grams = _with_grams(docs, text).withColumn("__weights", array)

    def total(hashes: str) -> Column:
        mask = F.lit(BUCKETS - 1).cast("long")
        return F.aggregate(
            F.col(hashes),
            F.lit(0.0),
            lambda s, h: s + F.get(F.col("__weights"), h.bitwiseAND(mask).cast("int")),
        )

    n = F.size("__words") + F.size("__pairs")
    mean = F.when(n > 0, (total("__words") + total("__pairs")) / n).otherwise(0.0)
    return grams.withColumn("llr", F.round(mean, 6)).drop("__shapes", "__pairs", "__weights")


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more in the same text."""
    windows = hashes
    for shift in (1, 2, 4):  # hashes of 2, 4 and then 8 words
        windows = _joined(windows, shift)
    return windows


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts to rows that have ``__words``."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(r"[^ \t-\x0D]"))
    doc = docs.withColumns({"__lines": lines, "__windows": repeated_words(F.col("__words"))})
    # Windows with their places, sorted: neighbours of equal hash are repeats.
    n = F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    doc = doc.withColumn(
        "__sorted", F.when(F.size(F.array_distinct("__windows")) < n, placed)
    )
    less = n - 1
    before = F.slice("__sorted", F.lit(1), less)
    after = F.slice("__sorted", F.lit(2), less)
    twice = F.zip_with(before, after, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda p: p.isNotNull()))))
    doc = doc.withColumn("__places", F.when(F.col("__sorted").isNotNull(), places))
    gaps = F.zip_with(
        F.slice("__places", F.lit(1), F.size("__places") - 1),
        F.slice("__places", F.lit(2), F.size("__places") - 1),
        lambda a, b: F.least(b - a, F.lit(REPEAT_WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(REPEAT_WINDOW), lambda s, g: s + g)
    n_words = F.size("__words").cast("long")
    n_repeat = F.when(F.col("__places").isNull(), 0).otherwise(covered).cast("long")
    return doc.withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(F.translate(content, _SPACES, "")).cast("long"),
            "n_symbols": F.regexp_count(content, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": n_repeat,
            "base_failed": (n_words < 20) | (n_repeat * 100 > n_words * 30),
        }
    ).drop("__words", "__lines", "__windows", "__sorted", "__places")


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All columns of docs, the base counts, ``llr``, base_failed and kept."""
    scored = with_score(docs, weights(docs, trusted, key, text), text)
    judged = with_base(scored, text)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
