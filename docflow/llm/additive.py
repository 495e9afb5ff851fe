"""Quality score by a generalised additive model with pairwise interactions.

A text is a row of a few numbers. Each number has a look-up table over its bins, and some pairs of numbers have one over coarser
bins; a score is the sum of what the tables say. The tables are learned by cyclic boosting: shallow trees of one number after the
other, each on what is left to explain, then the same over the pairs that explain most of the rest.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.session import Shared

#: What a text is described by, in order.
FEATURES = (
    "words", "word_length", "longest_word", "upper", "symbols", "shouts", "bars", "digits", "stops", "repeated_next", "distinct", "repeated_lines",
    "line_words", "marked_words",
)
#: Rows that are learned from, about; more are drawn down to it by a hash of the text.
MAX_ROWS = 20_000
_SYMBOLS = list(b"#*$%&|<>")
_STOPS = list(b".,;:")
_ENDS = tuple(bytes([c]) for c in b"#*$%&|<>!?")


def described(text: bytes) -> list[float]:
    """The numbers of one text: damped counts, and shares of characters, words or lines; zeros without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), sum(map(len, words))
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=128)
    upper, lower, digits = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return [
        float(np.log1p(n)), chars / n, float(np.log1p(max(map(len, words)))), upper / max(upper + lower, 1), int(count[_SYMBOLS].sum()) / chars,
        int(count[33] + count[63]) / n, int(count[124]) / n, digits / chars, int(count[_STOPS].sum()) / n, sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n, 1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), sum(w.endswith(_ENDS) for w in words) / n,
    ]


@dataclass(frozen=True)
class Settings:
    """How the tables are learned: bins of single numbers and of pairs, pairs, passes over all, leaves of a tree, rate, shrinkage."""

    bins: int = 48
    pair_bins: int = 8
    pairs: int = 10
    rounds: int = 120
    pair_rounds: int = 60
    leaves: int = 3
    rate: float = 0.15
    shrinkage: float = 2.0


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def shallow_tree(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """Per bin the value of its leaf, where gradients ``g`` and weights ``h`` are sums per bin; splits are made best first."""
    gain = lambda a, b: a * a / (b + s.shrinkage)

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        a, b = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        won = gain(a[:-1], b[:-1]) + gain(a[-1] - a[:-1], b[-1] - b[:-1]) - gain(a[-1], b[-1])
        at = int(won.argmax())
        return float(won[at]), lo + at + 1

    leaves = [(0, len(g))]
    while len(leaves) < s.leaves:
        won, at, leaf = max((*best(*leaf), leaf) for leaf in leaves)
        if won <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], at), (at, leaf[1])]
    out = np.zeros(len(g))
    for lo, hi in leaves:
        out[lo:hi] = s.rate * g[lo:hi].sum() / (h[lo:hi].sum() + s.shrinkage)
    return out


def quarters(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four, one cut along each side: what it explains, and the value of each cell."""
    a, b = np.pad(g, ((1, 0), (1, 0))).cumsum(0).cumsum(1), np.pad(h, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    gain, won = (lambda x, y: x * x / (y + s.shrinkage)), 0.0
    inner = slice(1, -1)
    for x, y in zip(four(a, inner), four(b, inner)):
        won = won + gain(x, y)
    won = won - gain(a[-1, -1], b[-1, -1])
    if not won.size:
        return 0.0, np.zeros(g.shape)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    out, rows, columns = np.zeros(g.shape), (slice(0, i + 1), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None))
    for r in rows:
        for c in columns:
            out[r, c] = s.rate * g[r, c].sum() / (h[r, c].sum() + s.shrinkage)
    return float(won[i, j]), out


def four(a: np.ndarray, inner: slice) -> tuple[np.ndarray, ...]:
    """Sums of the four parts for each pair of inner cuts, from sums up to each corner."""
    low, left, right, all_ = a[inner, inner], a[inner, -1:], a[-1:, inner], a[-1, -1]
    return low, left - low, right - low, all_ - left - right + low


@dataclass
class Model:
    """Tables over bins: ``edges`` and ``tables`` of each number, ``coarse`` bins of its bins, ``grids`` of pairs."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    grids: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the bins, a row for each of the texts' numbers."""
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]) if self.edges else np.zeros((0, len(x)), int)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1: the sums of the tables' entries for all rows at once."""
        bins, z = self.binned(x), np.full(len(x), self.start)
        for b, table in zip(bins, self.tables):
            z += table[b]
        for i, j, grid in self.grids:
            z += grid[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return chance(z)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Model:
        """Learn from numbers ``x`` and labels ``y`` of 0 and 1; with no rows, or rows of one label, the score is the same for all."""
        model = cls(start=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
        if len(y) == 0 or y.min() == y.max():
            return model
        quantiles = lambda column, n: np.unique(np.quantile(column, np.linspace(0, 1, n + 1)[1:-1]))
        model.edges = [quantiles(c, s.bins) for c in x.T]
        bins = model.binned(x)
        sizes = [len(e) + 1 for e in model.edges]
        model.coarse = [np.searchsorted(quantiles(b, s.pair_bins), np.arange(n), side="left") for b, n in zip(bins, sizes)]
        model.tables = [np.zeros(n) for n in sizes]
        z = np.full(len(y), model.start)
        for _ in range(s.rounds):
            for k, b in enumerate(bins):
                p = chance(z)
                step = shallow_tree(np.bincount(b, y - p, sizes[k]), np.bincount(b, p * (1 - p), sizes[k]), s)
                model.tables[k] += step
                z += step[b]
        cells = {(i, j): (model.coarse[i][bins[i]], model.coarse[j][bins[j]]) for i, j in combinations(range(len(bins)), 2)}
        wide = [int(c.max()) + 1 for c in model.coarse]

        def grid(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
            (i, j), (a, b), p = pair, cells[pair], chance(z)
            shape, at = (wide[i], wide[j]), a * wide[j] + b
            sums = [np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p))]
            return quarters(*sums, s)

        best = sorted(cells, key=lambda pair: (-grid(pair)[0], pair))[: s.pairs]
        found = {(i, j): np.zeros((wide[i], wide[j])) for i, j in best}
        for _ in range(s.pair_rounds):
            for pair in best:
                step = grid(pair)[1]
                found[pair] += step
                z += step[cells[pair]]
        model.grids = [(i, j, table) for (i, j), table in found.items()]
        return model


def describe(df: DataFrame, text: str = "text", result: str = "described") -> DataFrame:
    """``df`` with an array of floats ``result``, the numbers ``FEATURES`` of each whole text; a null text counts as empty.

    Other columns pass unchanged, one named ``result`` is replaced; equal rows stay, one each; an empty table gives an empty one.
    """

    @F.arrow_udf("array<float>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([described(x or b"") for x in column.cast(pa.binary()).to_pylist()], pa.list_(pa.float32()))

    return df.withColumn(result, run.asNondeterministic()(F.col(f"`{text}`")))


def fit(rows: DataFrame, features: str, label: str, same: str, max_rows: int = MAX_ROWS, settings: Settings = Settings()) -> Model:
    """Learn from ``rows`` whose ``label`` is 0 or 1; others, nulls included, are left out.

    Rows alike in ``same`` (a hash of the text) and label count once, so that no group of copies outweighs the rest. Of more than
    ``max_rows`` such rows about so many are drawn by that hash: only their few numbers come to the driver. They are
    sorted there, so that the model does not depend on how the rows were dealt.
    """
    known = rows.filter(F.col(label).isin(0, 1)).select(F.col(same).alias("same"), F.col(label).cast("int").alias("y"), F.col(features).alias("x"))
    known = known.groupBy("same", "y").agg(F.first("x").alias("x"))
    n = known.count()
    if n > max_rows:
        known = known.filter(F.pmod(F.xxhash64("same"), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    drawn = sorted(known.collect(), key=lambda r: (r["same"], r["y"]))
    x = np.array([r["x"] for r in drawn], np.float32).reshape(len(drawn), len(FEATURES))
    return Model.fit(x, np.array([r["y"] for r in drawn], float), settings)


def score(df: DataFrame, model: Model, features: str = "described", result: str = "score") -> DataFrame:
    """``df`` with a double ``result`` from 0 to 1, higher where label 1 is likelier; equal rows get equal scores."""
    shared = Shared(df.sparkSession, model)  # tables over bins: some hundred KB at most

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        return pa.array(shared.value.scores(x), pa.float64())

    return df.withColumn(result, run.asNondeterministic()(F.col(f"`{features}`")))


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether the checksum of the key as text falls into the first fold, which is not learned from; a null key does not."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
