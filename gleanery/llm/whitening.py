"""Whitening of embeddings by incremental eigendecomposition.

A ``Spectrum`` is the eigendecomposition of the scatter of the vectors seen so far, beside
their number and exact sums. Each partition starts one and applies a centred rank-one update
for every different vector, weighted by its copies. An update changes the eigenvalues to the
roots of a secular equation; components without weight, and all but one of those that share an
eigenvalue, are deflated and stay. Spectra are combined by rank-one updates again: one for
each direction of the smaller, one for the difference of the means. They meet in a tree of
bounded fan-in, each level written to the shared folder.

The combined eigenvectors span the space; one distributed pass projects all vectors on them
and gathers the scatter of the projections, and the eigenvectors of that small matrix turn
them (Rayleigh-Ritz), which takes out the rounding of all updates before.

What a task holds or sends is one matrix of dimension x dimension, whatever the rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

SCALE, SHIFT = 1024.0, 100_000
#: Scaled components beyond this are moved to it: doubles hold whole numbers up to here.
LARGEST = 1 << 52
#: Spectra or scatters that one task combines at each level.
FAN_IN = 16
EPS = np.finfo(np.float64).eps
STATE = "dim int, part long, state binary"


def _givens(a: float, b: float) -> tuple[float, float]:
    r = np.hypot(a, b)
    return a / r, b / r


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of diag(d) + z z', as the index of a nearby pole and the distance from it.

    ``d`` rises strictly and all ``z2`` (squares of z) are positive; root i lies between pole i
    and the next. All roots are sought together, each as a distance from the pole it is closer
    to, so that differences of roots and poles keep their digits.
    """
    k, total = len(d), float(z2.sum())
    index = np.arange(k)
    nearest, last = np.minimum(index + 1, k - 1), index == k - 1
    middle = np.append(np.diff(d), total) / 2
    apart = d[:, None] - d[None, :]  # [j, i]: pole j seen from pole i
    at_middle = 1 + z2 @ (1 / (apart - middle))
    # behind the last pole there is none to be closer to
    left = (at_middle >= 0) | last
    origin = np.where(left, index, nearest)
    poles = apart[:, origin]
    low, high = np.where(left, 0.0, -middle), np.where(left, middle, 0.0)
    if at_middle[-1] < 0:
        low[-1], high[-1] = middle[-1], total
    x = (low + high) / 2
    lower = (index[:, None] <= index[None, :]).astype(np.float64)  # poles at or below a root
    own, following = poles[index, index], poles[nearest, index]
    with np.errstate(all="ignore"):
        for _ in range(80):
            inverse = 1 / (poles - x)
            inverse_below, squares = inverse * lower, inverse * inverse
            terms, terms_below = z2 @ inverse, z2 @ inverse_below
            slopes, below = z2 @ squares, z2 @ (squares * lower)
            f = 1 + terms
            exact = np.abs(f) <= 8 * EPS * k * (1 + terms - 2 * terms_below)
            high, low = np.where(f > 0, x, high), np.where(f > 0, low, x)
            # f is replaced by a constant and one pole at each end, with its value and slopes
            p, q = own - x, following - x
            c = f - p * below - q * (slopes - below)
            a, b = (p + q) * f - p * q * slopes, p * q * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # behind the last pole only its own side is left: c + s / (p - step) = 0
            step[-1] = p[-1] + p[-1] * p[-1] * below[-1] / (f[-1] - p[-1] * below[-1])
            new = x + step
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            done = exact | (np.abs(new - x) <= 2 * EPS * np.abs(x)) | (new == low) | (new == high)
            x = np.where(exact, x, new)
            if done.all():
                break
    return origin, x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors of q diag(d) q' + rho v v', for rho not negative."""
    z = q.T @ v
    length = np.linalg.norm(z)
    if rho <= 0 or length == 0:
        return d, q
    rho, z = rho * length * length, z / length
    scale = max(d[-1], rho)
    # deflation: a component without weight stays; of those with one eigenvalue one keeps all weight
    heavy = rho * np.abs(z) > 8 * EPS * scale
    kept = np.flatnonzero(heavy)
    close = np.flatnonzero(np.diff(d[kept]) <= 8 * EPS * scale)
    if len(close):
        q, z, heavy = q.copy(), z.copy(), heavy.copy()
        for at in close.tolist():
            i, j = kept[at], kept[at + 1]
            cos, sin = _givens(z[j], z[i])
            q[:, i], q[:, j] = cos * q[:, i] - sin * q[:, j], sin * q[:, i] + cos * q[:, j]
            z[j], z[i], heavy[i] = np.hypot(z[i], z[j]), 0.0, False
        kept = np.flatnonzero(heavy)
    if not len(kept):
        return d, q
    own, weight = d[kept], rho * z[kept] ** 2
    if len(kept) == 1:
        values, turned = own + weight, q[:, kept]
    else:
        origin, distance = secular_roots(own, weight)
        values = own[origin] + distance
        away = own[:, None] - own[origin][None, :] - distance[None, :]  # [j, i]: pole j less root i
        # the z for which these roots are exact; with it the vectors are orthogonal to rounding
        apart = own[:, None] - own[None, :]
        ratio = away / np.where(apart == 0, 1, apart.T) * np.where(np.eye(len(own), dtype=bool), 1, -1)
        exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(z[kept])
        turn = exact[:, None] / away
        turned = q[:, kept] @ (turn / np.linalg.norm(turn, axis=0))
    d = d.copy()
    q = q.copy()
    d[kept], q[:, kept] = values, turned
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Number, exact sums and the eigendecomposition of the scatter of whole-number vectors."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, [0] * dim
        self.d, self.q = np.zeros(dim), np.eye(dim)

    def _centre(self, reference: list[int]) -> np.ndarray:
        """The mean less a whole-number vector, in double precision."""
        return np.array([(s - self.n * r) / self.n for s, r in zip(self.sums, reference)])

    def add(self, vectors: np.ndarray) -> None:
        """A block of vectors: one update for each different one."""
        rows, copies = np.unique(vectors, axis=0, return_counts=True)
        reference = rows[0].tolist() if not self.n else [s // self.n for s in self.sums]
        away = (rows - np.array(reference, np.int64)).astype(np.float64)
        mean = self._centre(reference) if self.n else np.zeros(len(reference))
        for row, count in zip(away, copies.tolist()):
            change = row - mean
            if self.n:
                self.d, self.q = rank_one(self.d, self.q, change, self.n * count / (self.n + count))
            self.n += count
            mean = mean + change * (count / self.n)
        # so many scaled components at a time keep within 64 bits
        for start in range(0, len(vectors), 512):
            self.sums = [a + b for a, b in zip(self.sums, vectors[start : start + 512].sum(0).tolist())]

    def combine(self, other: Spectrum) -> Spectrum:
        if not self.n or not other.n:
            return self if self.n else other
        large, small = (self, other) if self.n >= other.n else (other, self)
        out = Spectrum(len(self.sums))
        out.n, out.sums = self.n + other.n, [a + b for a, b in zip(self.sums, other.sums)]
        out.d, out.q = large.d, large.q
        reference = [s // large.n for s in large.sums]
        for value, direction in zip(small.d, small.q.T):
            out.d, out.q = rank_one(out.d, out.q, direction, float(value))
        between = large._centre(reference) - small._centre(reference)
        out.d, out.q = rank_one(out.d, out.q, between, large.n * small.n / out.n)
        return out

    def pack(self) -> bytes:
        head = json.dumps([self.n, self.sums]).encode()
        return len(head).to_bytes(8, "little") + head + self.d.tobytes() + self.q.tobytes()

    @classmethod
    def unpack(cls, state: bytes) -> Spectrum:
        size = 8 + int.from_bytes(state[:8], "little")
        n, sums = json.loads(state[8:size])
        out = cls(len(sums))
        numbers = np.frombuffer(state[size:], np.float64)
        out.n, out.sums = n, sums
        out.d, out.q = numbers[: len(sums)].copy(), numbers[len(sums) :].reshape(len(sums), -1).copy()
        return out


class Scatter:
    """Number, mean and scatter of vectors of doubles; combined without losing the centring."""

    def __init__(self, dim: int):
        self.n, self.mean, self.matrix = 0, np.zeros(dim), np.zeros((dim, dim))

    def add(self, rows: np.ndarray) -> None:
        part = Scatter(rows.shape[1])
        part.n, part.mean = len(rows), rows.mean(0)
        centred = rows - part.mean
        part.matrix = centred.T @ centred
        both = self.combine(part)
        self.n, self.mean, self.matrix = both.n, both.mean, both.matrix

    def combine(self, other: Scatter) -> Scatter:
        if not self.n or not other.n:
            return self if self.n else other
        out, away = Scatter(len(self.mean)), other.mean - self.mean
        out.n = self.n + other.n
        out.mean = self.mean + away * (other.n / out.n)
        out.matrix = self.matrix + other.matrix + np.outer(away, away) * (self.n * other.n / out.n)
        return out

    def pack(self) -> bytes:
        return self.n.to_bytes(8, "little") + self.mean.tobytes() + self.matrix.tobytes()

    @classmethod
    def unpack(cls, state: bytes) -> Scatter:
        numbers = np.frombuffer(state[8:], np.float64)
        dim = round((-1 + (1 + 4 * len(numbers)) ** 0.5) / 2)
        out = cls(dim)
        out.n, out.mean = int.from_bytes(state[:8], "little"), numbers[:dim].copy()
        out.matrix = numbers[dim:].reshape(dim, dim).copy()
        return out


def _states(states: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    dims, parts, packed = zip(*states) if states else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(dims, pa.int32()), common.longs(parts), pa.array(packed, pa.binary())], ["dim", "part", "state"]
    )


def _by_dim(batch: pa.RecordBatch, column: int):
    """The vectors of each dimension in a slice, as a matrix."""
    held: dict[int, list[np.ndarray]] = {}
    for vector in common.arrays_of(batch.column(column)):
        held.setdefault(len(vector), []).append(vector)
    return {dim: np.stack(own) for dim, own in held.items()}


def _gather(rows: DataFrame, kind: type, prepared=lambda dim, block: block) -> dict[int, Spectrum | Scatter]:
    """One ``kind`` for each dimension over all rows ``(v)``, combined in a tree."""

    def first(batches):
        made = {}
        for batch in common.slices(batches):
            for dim, block in _by_dim(batch, 0).items():
                block = prepared(dim, block)
                made.setdefault(dim, kind(block.shape[1])).add(block)
        part = TaskContext.get().partitionId()
        yield _states([(dim, part, x.pack()) for dim, x in made.items()])

    def together(batches):
        made = {}
        for batch in batches:
            dims, parts, packed = (c.to_pylist() for c in batch.columns)
            for dim, part, state in zip(dims, parts, packed):
                made.setdefault((dim, part // FAN_IN), []).append((part, state))
        out = []
        for (dim, group), states in made.items():
            whole, *others = (kind.unpack(s) for _, s in sorted(states))
            for other in others:
                whole = whole.combine(other)
            out.append((dim, group, whole.pack()))
        yield _states(out)

    common.prepare(rows.sparkSession)
    states = common.stage(rows.mapInArrow(first, STATE), "states")
    while (states.agg(F.max("part")).first()[0] or 0) > 0:
        group = F.floor(F.col("part") / FAN_IN)
        dealt = states.withColumn("level", group).repartition("dim", "level").drop("level")
        states = common.stage(dealt.mapInArrow(together, STATE), "states")
    # one state for each dimension
    return {r.dim: kind.unpack(bytes(r.state)) for r in states.collect()}


@dataclass(frozen=True)
class Model:
    """What whitens vectors of one dimension; eigenvalues fall, directions are columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """x - S/n in double precision: whole numbers are subtracted before anything is rounded."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (rows - whole) - rest

    def deviations(self, rows: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n*x - S)^2."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = rows - whole
        largest = int(np.abs(away).max(initial=0)) + 1
        if (largest * self.n) ** 2 * rows.shape[1] < 2**63:
            return ((away * self.n - rest) ** 2).sum(1).tolist()
        return [sum((a * self.n - r) ** 2 for a, r in zip(own, rest.tolist())) for own in away.tolist()]

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ (self.directions / np.sqrt(self.values))


def integers(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with ``v``: floor(1024 * c) + 100000 of every component; unusable rows are left out."""
    name = common.fresh(df, "v")
    x = F.col(f"`{vector}`").cast("array<double>")
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    ends = F.lit(float(LARGEST))
    scaled = F.transform(x, lambda c: F.floor(F.greatest(-ends, F.least(ends, c * SCALE))) + SHIFT)
    return df.where(usable).withColumn(name, scaled)


def fit(rows: DataFrame, vector: str, components: int) -> dict[int, Model]:
    """A model for each dimension of the whole-number vectors of ``rows``."""
    own = rows.select(F.col(f"`{vector}`").alias("v"))
    spectra = _gather(own, Spectrum)
    start = {
        dim: Model(s.n, s.sums, np.ones(dim), np.ascontiguousarray(s.q[:, ::-1]), 0.0) for dim, s in spectra.items()
    }
    shared = rows.sparkSession.sparkContext.broadcast(start)
    # Rayleigh-Ritz: with all directions the projections have the whole scatter
    turned = _gather(own, Scatter, lambda dim, block: shared.value[dim].centred(block) @ shared.value[dim].directions)
    models = {}
    for dim, first in start.items():
        values, turn = np.linalg.eigh(turned[dim].matrix / first.n)
        values, directions = values[::-1], first.directions @ turn[:, ::-1]
        trace = float(values.sum())
        sound = values > 64 * EPS * dim * max(trace, EPS)
        used = int(min(components, np.cumprod(sound).sum()))
        models[dim] = Model(first.n, first.sums, values[:used].copy(), directions[:, :used].copy(), trace)
    return models


def whiten(
    df: DataFrame, models: dict[int, Model], vector: str, made: str = "white"
) -> DataFrame:
    """Rows of ``df`` with a struct ``made``: ``deviation decimal(38,0)`` and ``whitened array<double>``.

    A row whose vector is null or of a dimension without a model has a null struct, a deviation
    of more than 38 digits is null.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(given: pa.Array) -> pa.Array:
        out: list[dict | None] = [None] * len(given)
        places: dict[int, list[int]] = {}
        held = list(common.arrays_of(given))
        for place, vector in enumerate(held):
            if len(vector) in shared.value:
                places.setdefault(len(vector), []).append(place)
        for dim, own in places.items():
            block = np.stack([held[p] for p in own])
            model = shared.value[dim]
            for place, far, white in zip(own, model.deviations(block), model.whitened(block).tolist()):
                out[place] = {"deviation": far if far < 10**38 else None, "whitened": white}
        return pa.array(out, pa.struct([("deviation", pa.decimal128(38)), ("whitened", pa.list_(pa.float64()))]))

    kind = "struct<deviation:decimal(38,0),whitened:array<double>>"
    return common.append_column(df, run, F.col(f"`{vector}`"), made, kind, as_list=False)


def whitening(df: DataFrame, *, vector: str = "embedding", id: str = "vec_id", components: int = 8) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` by row and component.

    Rows whose vector is null, empty, or holds a null or a non-finite entry are left out. Vectors
    of each dimension are fitted by themselves. Components without variance can't be whitened and
    have no rows, so there are fewer where the vectors span less, none for one vector. Repeated
    rows, and rows of a null id, stay as they are. ``deviation`` is exact; ``identity_error`` is
    one value for each dimension. Other columns are left out.
    """
    rows = integers(df.select(F.col(f"`{id}`").alias("of"), F.col(f"`{vector}`").alias("x")), "x").select("of", "v")
    models = fit(rows, "v", components)
    white = common.stage(
        whiten(rows, models, "v").select("of", F.size("v").alias("dim"), "white.deviation", "white.whitened"), "white"
    )
    spread = _identity_errors(white, models)
    facts = [
        (dim, c + 1, m.n, float(m.values[c] / m.trace), spread[dim])
        for dim, m in models.items()
        for c in range(len(m.values))
    ]
    schema = "dim int, component int, n long, explained double, identity_error double"
    known = df.sparkSession.createDataFrame(facts, schema)
    each = white.select("of", "dim", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    named = each.withColumn("component", F.col("place") + 1)
    # a row for each dimension and component
    return named.join(F.broadcast(known), ["dim", "component"]).select(
        F.col("of").alias(id), "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


def _identity_errors(white: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By dimension, how far the covariance of what was whitened is from the identity."""
    out = {}
    for dim, model in models.items():
        if not len(model.values):
            continue
        of_dim = white.where(F.col("dim") == dim).select(F.col("whitened").alias("v"))
        spread = _gather(of_dim, Scatter)[len(model.values)]
        out[dim] = float(np.abs(spread.matrix / spread.n - np.eye(len(model.values))).max())
    return out


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first eight components; a deviation beyond 64 bits is null."""
    made = whitening(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))
