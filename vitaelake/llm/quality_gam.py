"""Quality classifier: a generalised additive model with pairwise interactions.

The log-odds of a good text are a sum of one lookup table per feature and of some
tables over pairs of features. Training goes round the features again and again,
each time adding a small step of a shallow tree on that feature's bins alone, and
then in the same way round the pairs that explain most of what is left. Trees over
bins are sums over bins, so all that remains of them is the tables; scoring adds
one looked-up number per feature and pair.

Features come from the text alone and are computed once, in Arrow batches. The
model is fitted on at most ``max_rows`` labelled rows, those of smallest id hash;
every row is scored. NULL texts are empty and are scored like empty ones. Rows
without a label or with a NULL label are not learnt from; labels that all agree, or
none at all, give that constant.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import NOT_SPACE, Words, pieces, summed_by
from vitaelake.sources.staging import stage

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.1
RIDGE = 1.0

FEATURES = (
    "log_words", "word_bytes", "symbols", "capitals", "digits", "breaks", "new_words",
    "same_as_before", "stops", "shouts", "bars", "non_ascii", "old_lines", "line_words",
    "short_words", "long_words",
)

_NOT_BREAK = np.ones(256, dtype=bool)
_NOT_BREAK[10] = False


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[list(characters)] = 1
    return table


_CLASSES = {
    "symbols": _class(b"#*$%&<>"),
    "capitals": _class(bytes(range(65, 91))),
    "digits": _class(b"0123456789"),
    "breaks": _class(b"\n"),
    "stops": _class(b".,;:?"),
    "shouts": _class(b"!"),
    "bars": _class(b"|"),
    "non_ascii": _class(bytes(range(128, 256))),
}


def _new_share(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of distinct values among those of each text; 1 where there are none."""
    out = np.ones(len(first) - 1)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b - a > 1:
            out[i] = len(np.unique(hashes[a:b])) / (b - a)
    return out


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row per text, in the order of ``FEATURES``."""
    words = Words(data, bounds, NOT_SPACE, lower=False)
    lines = Words(data, bounds, _NOT_BREAK, lower=False)
    n, size = words.counts, np.diff(bounds)
    per_word, per_byte = np.maximum(n, 1), np.maximum(size, 1)
    length = words.ends - words.starts
    again = np.zeros(len(length), dtype=np.int64)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    begins = words.first[:-1]
    again[begins[begins < len(again)]] = 0
    counted = {k: summed_by(t[data], bounds) / per_byte for k, t in _CLASSES.items()}
    columns = counted | {
        "log_words": np.log1p(n),
        "word_bytes": summed_by(length, words.first) / per_word,
        "new_words": _new_share(words.hashes, words.first),
        "same_as_before": summed_by(again, words.first) / per_word,
        "old_lines": 1 - _new_share(lines.hashes, lines.first),
        "line_words": np.log1p(n / np.maximum(lines.counts, 1)),
        "short_words": summed_by((length <= 3).astype(np.int64), words.first) / per_word,
        "long_words": summed_by((length >= 12).astype(np.int64), words.first) / per_word,
    }
    return np.column_stack([columns[k] for k in FEATURES])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in pieces(batch.column(1)):
            rows = features(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(pa.array(x) for x in rows.T)],
                names=["id", *FEATURES],
            )


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, features) of every row, as a table of the shared folder."""
    kind = docs.schema[key].dataType.simpleString()
    shape = ", ".join([f"id {kind}", *(f"{name} double" for name in FEATURES)])
    return stage(docs.select(F.col(key), F.col(text)).mapInArrow(_featured, shape), "features")


@dataclass
class Model:
    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], side="right")]
        coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return total


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Best steps of a tree of up to ``leaves`` leaves over ordered bins."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(cuts) - 1 < leaves:
        best, where = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = np.arange(a + 1, b)
            if not len(at):
                continue
            gains = (
                _gain(G[at] - G[a], H[at] - H[a]) + _gain(G[b] - G[at], H[b] - H[at])
                - _gain(G[b] - G[a], H[b] - H[a])
            )
            if gains.max() > best:
                best, where = gains.max(), int(at[gains.argmax()])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.empty(len(g))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + RIDGE)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best single cut of each of two features."""
    G, H = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))
    n, m = g.shape

    def quarters(t: np.ndarray, i, j) -> list[np.ndarray]:
        left, top, all_ = t[i, m], t[n, j], t[n, m]
        return [t[i, j], left - t[i, j], top - t[i, j], all_ - left - top + t[i, j]]

    i, j = (x.ravel() for x in np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij"))
    gains = sum(_gain(a, b) for a, b in zip(quarters(G, i, j), quarters(H, i, j)))
    k = int(gains.argmax())
    values = [a / (b + RIDGE) for a, b in zip(quarters(G, i[k], j[k]), quarters(H, i[k], j[k]))]
    out = np.empty_like(g)
    out[: i[k], : j[k]], out[: i[k], j[k] :] = values[0], values[1]
    out[i[k] :, : j[k]], out[i[k] :, j[k] :] = values[2], values[3]
    return float(gains[k] - _gain(G[n, m], H[n, m])), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the bins of single features, then of pairs."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    quantiles = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) if len(y) else np.empty(0) for c in x.T]
    coarse = [np.unique(np.quantile(c, np.arange(1, PAIR_BINS) / PAIR_BINS)) if len(y) else np.empty(0) for c in x.T]
    model = Model(start, quantiles, [np.zeros(len(e) + 1) for e in quantiles], [], coarse, [])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(quantiles, x.T)]
    total = np.full(len(y), start)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, own in zip(model.tables, bins):
            g, h = gradient()
            step = RATE * _tree(np.bincount(own, g, len(table)), np.bincount(own, h, len(table)))
            table += step
            total += step[own]

    wide = [np.searchsorted(e, c, side="right") for e, c in zip(coarse, x.T)]
    shapes = [len(e) + 1 for e in coarse]

    def grids(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = gradient()
        at, size = wide[a] * shapes[b] + wide[b], shapes[a] * shapes[b]
        return tuple(np.bincount(at, v, size).reshape(shapes[a], shapes[b]) for v in (g, h))

    usable = [p for p in combinations(range(len(shapes)), 2) if min(shapes[p[0]], shapes[p[1]]) > 1]
    ranked = sorted(usable, key=lambda p: -_cross(*grids(*p))[0])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros((shapes[a], shapes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * _cross(*grids(a, b))[1]
            table += step
            total += step[wide[a], wide[b]]
    return model


def train(featured: DataFrame, labels: DataFrame, key: str, label: str, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the ``max_rows`` labelled rows of smallest id hash."""
    marked = labels.select(F.col(key).alias("id"), F.col(label).cast("double").alias("y")).dropna()
    marked = featured.join(marked, "id").withColumn("__h", F.xxhash64("id"))
    # The hash to stop at is found first, so that the driver gets these rows and no others.
    last = marked.select("__h").orderBy("__h").limit(max_rows).agg(F.max("__h")).first()[0]
    chosen = marked.filter(F.col("__h") <= (last if last is not None else 0))
    rows = chosen.orderBy("__h", "y", *FEATURES).limit(max_rows)
    table = rows.select("y", *FEATURES).toPandas().to_numpy(dtype=np.float64).reshape(-1, 1 + len(FEATURES))
    return fit(table[:, 1:], table[:, 0])


def score(featured: DataFrame, model: Model) -> DataFrame:
    """(id, score) of every row; the score is the probability of a good text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(1 + k).to_numpy() for k in range(len(FEATURES))])
            scores = 1 / (1 + np.exp(-model.log_odds(x)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    kind = featured.schema["id"].dataType.simpleString()
    return featured.select("id", *FEATURES).mapInArrow(run, f"id {kind}, score double")
