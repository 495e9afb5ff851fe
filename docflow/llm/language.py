"""Language identification in two steps: the family first, then linear support vector machines between its languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm import texts
from docflow.session import Shared

#: Families of languages by their codes (fixed values); a language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sr": "slavic",
}
UNKNOWN = "und"
WIDTH = 4096
PER_LANGUAGE = 1500

#: Lower case for A-Z, a space for every other ASCII byte that is no letter; bytes beyond ASCII stay.
_FOLD = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Damped counts of hashed runs of two and three bytes of the folded text, at unit length."""
    folded = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16)
    bins = np.concatenate([(two + np.uint32(1 << 24)) * np.uint32(0x9E3779B1), three * np.uint32(0x85EBCA6B)]) >> np.uint32(20)
    counts = np.log1p(np.bincount(bins, minlength=WIDTH)).astype(np.float32)
    return counts / max(float(np.sqrt(counts @ counts)), 1e-9)


@dataclass(frozen=True)
class Machine:
    """A linear machine between two classes; positive margins are the first."""

    first: str
    second: str
    weights: np.ndarray
    offset: float

    @classmethod
    def fit(cls, first: str, second: str, a: np.ndarray, b: np.ndarray, penalty: float = 1e-4, epochs: int = 20) -> Machine:
        """Hinge loss by stochastic subgradients, both classes drawn alike, weights averaged over the last half."""
        rng = np.random.default_rng(7)
        w, c, mean, mean_c, n = np.zeros(WIDTH), 0.0, np.zeros(WIDTH), 0.0, 0
        steps, size = epochs * max(1, (len(a) + len(b)) // 64), 32
        for t in range(1, steps + 1):
            x = np.concatenate([a[rng.integers(len(a), size=size)], b[rng.integers(len(b), size=size)]])
            y = np.repeat([1.0, -1.0], size)
            late = y * (x @ w + c) < 1
            rate = 1 / (penalty * (t + 100))
            step = (y * late) @ x / len(y)
            w = (1 - rate * penalty) * w + rate * step
            w *= min(1.0, 1 / np.sqrt(penalty) / max(np.linalg.norm(w), 1e-12))
            c += min(rate, 1.0) * float((y * late).mean())
            if t > steps // 2:
                mean, mean_c, n = mean + w, mean_c + c, n + 1
        return cls(first, second, (mean / n).astype(np.float32), mean_c / n)

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset


class Duel:
    """One-versus-one machines between classes; each pair's winner gets a vote, margins break ties."""

    def __init__(self, samples: dict[str, np.ndarray]):
        self.names = sorted(samples)
        self.machines = [Machine.fit(p, q, samples[p], samples[q]) for p, q in combinations(self.names, 2)]

    def winners(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best class of each row, and its weakest chance against another (1 without another)."""
        votes = np.zeros((len(x), len(self.names)))
        chance = np.ones((len(x), len(self.names)))
        for m in self.machines:
            p = 1 / (1 + np.exp(-np.clip(2 * m.margins(x), -30, 30)))
            i, j = self.names.index(m.first), self.names.index(m.second)
            votes[:, i] += (p >= 0.5) + p / 1e3
            votes[:, j] += (p < 0.5) + (1 - p) / 1e3
            chance[:, i], chance[:, j] = np.minimum(chance[:, i], p), np.minimum(chance[:, j], 1 - p)
        best = votes.argmax(axis=1)
        return best, chance[np.arange(len(x)), best]


class Hierarchy:
    """Families are told apart first, then the languages of the family found."""

    def __init__(self, samples: dict[str, np.ndarray], families: dict[str, str]):
        of = {language: families.get(language, language) for language in samples}
        members = {f: {x: samples[x] for x in samples if of[x] == f} for f in sorted(set(of.values()))}
        self.families = Duel({f: balanced(list(m.values())) for f, m in members.items()})
        self.within = [Duel(members[f]) for f in self.families.names]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.families.winners(x)
        names = [""] * len(x)
        for k, duel in enumerate(self.within):
            rows = np.flatnonzero(family == k)
            if len(rows):
                best, chance = duel.winners(x[rows])
                score[rows] *= chance
                for r, b in zip(rows.tolist(), best.tolist()):
                    names[r] = duel.names[b]
        return names, score


def balanced(parts: list[np.ndarray]) -> np.ndarray:
    """The languages of a family in equal shares, repeated where one has fewer samples."""
    most = max(map(len, parts))
    return np.concatenate([p[np.arange(most) % len(p)] for p in parts])


def fit(df: DataFrame, text: str, language: str, families: dict[str, str] = FAMILIES, per_language: int = PER_LANGUAGE) -> Hierarchy | None:
    """Learn from rows with a language and a letter; None if there are none.

    A sample of about ``per_language`` different texts of each language is drawn by a hash of the text, which is the only bound:
    copies count once, so that no frequent text outweighs the others or fills the driver. Whole texts are turned into features
    by Spark, and only their few hundred numbers come to the driver, where the machines are fitted.
    """
    rows = df.select(F.col(text).alias("text"), F.col(language).alias("language")).filter("text is not null and language is not null")
    rows = rows.withColumn("same", F.xxhash64("text"))
    counts = {r["language"]: r["count"] for r in rows.select("language", "same").distinct().groupBy("language").count().collect()}  # a row per language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) < share[F.col("language")] * (1 << 30)

    @F.arrow_udf("struct<at:array<smallint>,value:array<float>>")
    def sparse(column: pa.Array) -> pa.Array:
        found = [features(x) if has_letter(x) else np.zeros(0, np.float32) for x in column.to_pylist()]
        at = [np.flatnonzero(f) for f in found]
        kinds = pa.list_(pa.int16()), pa.list_(pa.float32())
        return texts.struct_of([("at", [a.astype(np.int16) for a in at], kinds[0]), ("value", [f[a] for f, a in zip(found, at)], kinds[1])])

    samples: dict[str, list[np.ndarray]] = {}
    each = rows.filter(drawn).groupBy("language", "same").agg(F.first("text").alias("text"))
    f = sparse.asNondeterministic()("text").alias("f")
    taken = each.select("language", "same", f).select("language", "same", "f.at", "f.value").toArrow()
    # sorted, so that the machines do not depend on how rows were dealt; a row at a time leaves Arrow
    for row in taken.sort_by([("language", "ascending"), ("same", "ascending")]).to_batches(max_chunksize=64):
        for name, at, value in zip(row.column("language").to_pylist(), row.column("at"), row.column("value")):
            if len(at.values):
                x = np.zeros(WIDTH, np.float32)
                x[at.values.to_numpy()] = value.values.to_numpy()
                samples.setdefault(name, []).append(x)
    del taken
    return Hierarchy({k: np.stack(v) for k, v in samples.items()}, families) if samples else None


def identify(df: DataFrame, model: Hierarchy | None, text: str = "text", result: str = "language") -> DataFrame:
    """``df`` with a struct ``result``: prediction (a learned language, or ``und``) and score from 0 to 1.

    The score is the chance of the family times that of the language within it, each the weakest against any other.
    A null text and one without a letter, and any text if nothing was learned, are ``und`` with score 0. Whole texts are
    used, whatever their length. Equal texts get equal results. Other columns pass unchanged; one named
    ``result`` is replaced. An empty table gives an empty one.
    """
    shared = Shared(df.sparkSession, model)

    @F.arrow_udf("struct<prediction:string,score:double>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted: Hierarchy | None = shared.value
        for column in columns:
            names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
            held: list[int] = []
            x: list[np.ndarray] = []
            for k in range(len(column)):
                value = column[k].as_py()
                if fitted is not None and has_letter(value):
                    held.append(k)
                    x.append(features(value))
                if held and (len(held) == 512 or k == len(column) - 1):
                    found, scores[held] = fitted.predict(np.stack(x))
                    for i, name in zip(held, found):
                        names[i] = name
                    held, x = [], []
            yield texts.struct_of([("prediction", names, pa.string()), ("score", scores.tolist(), pa.float64())])

    return df.withColumn(result, predict.asNondeterministic()(F.col(text)))


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the checksum of the key as text falls into the fold that is not learned from; a null key does not."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
