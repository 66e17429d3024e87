"""URL rules as one bit-parallel wildcard automaton.

All glob patterns are packed side by side into 64-bit words: one bit per position
of a pattern. A byte of a URL moves every bit of every pattern at once (Shift-And
with self-loops for wildcards), and the URLs of a batch move in step. In a pattern
``*`` stands for bytes other than ``/``, ``**`` for any bytes, ``?`` for one byte
other than ``/``.

A URL's canonical form is its host (A-Z lowered) and its path, without scheme,
query and fragment. NULL URLs and those without ``://`` have an empty host and
path, which no host rule fits. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import raw_text

_U64 = np.uint64
PIECE_URLS = 20_000


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


#: What decides where no rule fits: a URL that one of these fits is blocked.
DEFAULT_BLOCKED = (
    "*/**/wp-login.php",
    "*/wp-login.php",
    "*/wp-admin/**",
    "*/cgi-bin/**",
    "*/login",
    "*/logout",
    "*/**/cart/checkout**",
    "*/**.exe",
    "*/**.zip",
    "ads.*/**",
    "*.doubleclick.*/**",
)


class Automaton:
    """Bit masks of a list of globs; state 0 of each glob is its first bit."""

    def __init__(self, globs: Sequence[str]):
        masks: list[tuple[set[int], set[int]]] = []  # bytes that enter a state, and that keep it
        accepts, begins = [], []
        every, segment = set(range(256)), set(range(256)) - {ord("/")}
        for glob in globs:
            begins.append(len(masks))
            masks.append((set(), set()))
            symbols = glob.encode()
            at = 0
            while at < len(symbols):
                if symbols[at : at + 2] == b"**":
                    masks[-1][1].update(every)
                    at += 2
                elif symbols[at] == ord("*"):
                    masks[-1][1].update(segment)
                    at += 1
                else:
                    masks.append((segment if symbols[at] == ord("?") else {symbols[at]}, set()))
                    at += 1
            accepts.append(len(masks) - 1)
        words = -(-max(len(masks), 1) // 64)
        self.enter = np.zeros((256, words), dtype=_U64)
        self.keep = np.zeros((256, words), dtype=_U64)
        self.begin = np.zeros(words, dtype=_U64)
        for state, (enter, keep) in enumerate(masks):
            bit = _U64(1) << _U64(state % 64)
            for table, symbols in ((self.enter, enter), (self.keep, keep)):
                for symbol in symbols:
                    table[symbol, state // 64] |= bit
        for state in begins:
            self.begin[state // 64] |= _U64(1) << _U64(state % 64)
        self.accepts = np.array(accepts, dtype=np.int64)

    def fits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of flags, one per glob, for each string data[start:end]."""
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        states = np.tile(self.begin, (len(starts), 1))
        # The longest come first, so those still running are a prefix.
        running = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
        for step, n in enumerate(running):
            live = states[:n]
            symbols = data[starts[:n] + step]
            moved = live << _U64(1)
            moved[:, 1:] |= live[:, :-1] >> _U64(63)
            moved &= self.enter[symbols]
            moved |= live & self.keep[symbols]
            states[:n] = moved
        bits = states[:, self.accepts // 64] >> (self.accepts % 64).astype(_U64) & _U64(1)
        out = np.empty((len(starts), len(self.accepts)), dtype=bool)
        out[order] = bits.astype(bool)
        return out


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL as columns that are never NULL."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _judged(rules: Sequence[Rule], blocked: Sequence[str], width: int):
    globs = [g for rule in rules for g in rule.globs] + list(blocked)
    automaton = Automaton(globs)
    # The longest fitting rule decides; of equally long ones the first.
    ranked = sorted(range(len(rules)), key=lambda i: -len(rules[i].name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str | None] = []
            verdicts: list[str] = []
            data, bounds = raw_text(batch.column(width))
            for lo in range(0, len(bounds) - 1, PIECE_URLS):
                cut = bounds[lo : lo + PIECE_URLS + 1]
                fits = automaton.fits(data, cut[:-1], cut[1:])
                by_rule = fits[:, : 2 * len(rules)].reshape(len(fits), len(rules), 2).any(axis=2)
                chosen = np.full(len(fits), -1)
                for i in reversed(ranked):
                    chosen[by_rule[:, i]] = i
                default = np.where(fits[:, 2 * len(rules) :].any(axis=1), "block", "allow")
                names += [None if i < 0 else rules[i].name for i in chosen]
                verdicts += [d if i < 0 else rules[i].verdict for i, d in zip(chosen, default)]
            columns = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=[*batch.schema.names[:width], "rule", "verdict"],
            )

    return run


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    blocked: Sequence[str] = DEFAULT_BLOCKED,
) -> DataFrame:
    """key, host, path, rule (NULL where none fits) and verdict of every row."""
    host, path = canonical(F.col(url))
    parts = pages.select(F.col(key), host.alias("__host"), path.alias("__path"))
    ready = parts.select(
        F.col(key).alias("__key"), "__host", "__path", F.concat("__host", "__path").alias("__url")
    )
    kind = pages.schema[key].dataType.simpleString()
    out = ready.mapInArrow(
        _judged(list(rules), list(blocked), 3),
        f"__key {kind}, __host string, __path string, rule string, verdict string",
    )
    return out.select(
        F.col("__key").alias(key),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        "rule",
        "verdict",
    )
