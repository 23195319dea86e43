"""Operator 13: whitening of embeddings by QDWH spectral divide-and-conquer.

Entries become integers (``scale`` times, rounded down), and the covariance is that of the distinct
integer vectors. Counts and sums are exact; products are centred first. Only sums cross the network:
each task adds up its rows, so the driver gets a table of the vector's width, whatever the row count.

The covariance is split without an eigenvalue routine: the polar factor of the covariance minus a
shift, from the QR-based dynamically weighted Halley iteration, is a matrix sign; with it (sign + I) / 2
projects on the eigenvectors above the shift. Orthonormal bases of that space and the rest split the
matrix in two, and so on down to single components. The leading ones, with their eigenvalues, go to
the tasks (a few numbers a dimension) and whiten every row.

Edge cases: rows whose vector is null, empty, holds null or non-finite entries, or is shorter than the
longest one go; integers end at the bounds of 64 bits, a deviation beyond them is null; repeated rows and
equal vectors all come back, but count once in the fit; a component without variance (one distinct vector, fewer
distinct vectors than components) whitens to 0, explains 0 and stays out of the identity error; an
empty table, or one without a usable vector, gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import scratch_table

EPS = float(np.finfo(np.float64).eps)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its sign."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    try:
        low = min(0.9, 0.9 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(n)))
    except np.linalg.LinAlgError:
        low = EPS
    low = max(low, EPS) if np.isfinite(low) else EPS
    for _ in range(30):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        now = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        moved, x = np.linalg.norm(now - x), now
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return (x + x.T) / 2


def halves(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int, float]:
    """An orthogonal basis whose first k vectors span the eigenvectors above ``shift``, k, and what couples both."""
    n = len(a)
    above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(float(np.trace(above))))
    if not 0 < k < n:
        return np.eye(n), k, 0.0
    below = np.eye(n) - above
    basis = rng.standard_normal((n, n))
    for _ in range(2):
        basis, _ = np.linalg.qr(np.hstack([above @ basis[:, :k], below @ basis[:, k:]]))
    return basis, k, float(np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:]))


def spectrum(a: np.ndarray, leading: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix; only the ``leading`` first, if given."""
    rng = np.random.default_rng(13)
    size = max(float(np.linalg.norm(a)), np.finfo(np.float64).tiny)

    def split(part: np.ndarray, wanted: int) -> np.ndarray:
        """Eigenvectors of ``part``, as columns by falling eigenvalue: the first ``wanted`` at least."""
        n = len(part)
        part = (part + part.T) / 2
        middle = np.trace(part) / n
        if n == 1 or np.linalg.norm(part - middle * np.eye(n)) <= 4 * EPS * size:
            return np.eye(n)
        # all eigenvalues lie between these; the shift moves to the half that holds them until it parts them
        reach = np.linalg.norm(part - middle * np.eye(n))
        low, high, shift = middle - reach, middle + reach, float(np.median(np.diag(part)))
        for _ in range(200):
            basis, k, coupled = halves(part, shift, rng)
            if 0 < k < n and coupled <= 100 * n * EPS * size:
                break
            if k >= n:
                low = shift
            elif k <= 0:
                high = shift
            # an eigenvalue met the shift: beside it
            else:
                shift += (high - low) * rng.uniform(-0.25, 0.25)
                continue
            shift = (low + high) / 2
            if high - low <= 4 * EPS * size:
                return np.eye(n)
        else:
            return np.eye(n)
        top = basis[:, :k] @ split(basis[:, :k].T @ part @ basis[:, :k], min(wanted, k))
        if wanted <= k:
            return top
        return np.hstack([top, basis[:, k:] @ split(basis[:, k:].T @ part @ basis[:, k:], wanted - k)])

    wanted = min(leading or len(a), len(a))
    vectors = split(a, wanted)
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def integers(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and x (array of bigint) of the rows with a usable vector."""
    vector = F.col(vector_col).cast("array<double>")
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    found = rows.select(F.col(id_col).alias("vec_id"), F.when(sound & (F.size(vector) > 0), vector).alias("v")).where("v is not null")
    return found.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("x"))


def stacked(arrays) -> np.ndarray:
    return np.stack(arrays.to_numpy())


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""
    entries = fit.select(F.posexplode("x").alias("at", "value"))
    rows = entries.groupBy("at").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()  # one row a dimension
    return rows[0]["n"], [int(r["s"]) for r in rows]


def centred_products(fit: DataFrame, column: str, width: int, centre: np.ndarray) -> np.ndarray:
    """Sum over the rows of (x - centre)(x - centre)': each task's sum, then one row of the matrix a group."""

    def add(frames):
        total = np.zeros((width, width))
        for f in frames:
            if len(f):
                z = stacked(f["x"]).astype(np.float64) - centre
                total += z.T @ z
        yield pd.DataFrame({"at": np.arange(width), "part": list(total)})

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": f["at"].iloc[:1], "part": [stacked(f["part"]).sum(axis=0)]})

    kind = "at bigint, part array<double>"
    parts = fit.select(F.col(column).alias("x")).mapInPandas(add, kind).groupBy("at").applyInPandas(merge, kind).collect()
    out = np.zeros((width, width))
    for r in parts:
        out[r["at"]] = r["part"]
    return (out + out.T) / 2


class Whitening:
    """What the fit found: n, sums, eigenvalues, components (columns), trace and the identity error."""

    def __init__(self, n: int, total: list[int], values: np.ndarray, components: np.ndarray, trace: float):
        self.n, self.total, self.values, self.components, self.trace = n, total, values, components, trace
        self.mean = np.array([s / n for s in total])
        self.varies = values > len(total) * EPS * max(trace, 0.0) * 8
        self.factors = components / np.sqrt(np.where(self.varies, values, 1.0)) * self.varies
        self.explained = np.where(self.varies, values / trace, 0.0) if trace > 0 else np.zeros(len(values))
        self.identity_error = 0.0


def whitened_of(rows: DataFrame, machine: Whitening) -> DataFrame:
    """``rows`` (vec_id as a string, x, deviation) plus ``whitened``, the array of each row's projections."""
    mean, factors = machine.mean, machine.factors

    def run(frames):
        for f in frames:
            if len(f):
                yield f.drop(columns="x").assign(whitened=list((stacked(f["x"]).astype(np.float64) - mean) @ factors))

    return rows.mapInPandas(run, "vec_id string, deviation bigint, whitened array<double>")


def deviation_of(x: Column, machine: Whitening, largest: int) -> Column:
    """Sum over the dimensions of (n x - S)^2, exact; null where it doesn't fit into 64 bits."""
    fits = len(machine.total) * (2 * machine.n * largest) ** 2 < 1 << 63
    kind = "bigint" if fits else "decimal(38,0)"
    n, zero = F.lit(machine.n).cast(kind), F.lit(0).cast(kind)
    total = F.array(*[F.lit(str(s)).cast(kind) for s in machine.total])
    if fits:
        return F.aggregate(F.zip_with(x, total, lambda a, s: (n * a - s) * (n * a - s)), zero, lambda t, z: t + z)
    apart = F.zip_with(x, total, lambda a, s: F.try_subtract(F.try_multiply(n, a.cast("decimal(38,0)")).cast(kind), s).cast(kind))
    squares = F.transform(apart, lambda z: F.try_multiply(z, z).cast(kind))
    return F.aggregate(squares, zero, lambda t, z: F.try_add(t, z).cast(kind)).try_cast("bigint")


def fit(x: DataFrame, leading: int) -> Whitening:
    """Fitted on the distinct vectors of ``x``, all of one width; ``x`` has one at least."""
    distinct = scratch_table(x.select("x").distinct(), "distinct-vectors")
    n, total = sums(distinct)
    mean = np.array([s / n for s in total])
    covariance = centred_products(distinct, "x", len(total), mean) / n
    values, components = spectrum(covariance, leading)
    machine = Whitening(n, total, values, components, float(np.trace(covariance)))
    live = np.flatnonzero(machine.varies)
    if len(live):
        # measured on the whitened vectors themselves, centred by their own mean
        rows = distinct.select(F.lit("").alias("vec_id"), "x", F.lit(0).cast("bigint").alias("deviation"))
        white = scratch_table(whitened_of(rows, machine).select(F.col("whitened").alias("y")), "whitened-fit")
        means = {r["at"]: r["m"] for r in white.select(F.posexplode("y").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m")).collect()}
        found = centred_products(white, "y", len(values), np.array([means[i] for i in range(len(values))])) / n
        machine.identity_error = float(np.abs(found[np.ix_(live, live)] - np.eye(len(live))).max())
    return machine


def whiten(rows: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = rows.schema[id_col].dataType
    x = scratch_table(integers(rows, id_col, vector_col, scale), "integer-vectors")
    width, largest = x.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda a: F.greatest(a, -F.greatest(a, F.lit(-(2**63 - 1)))))))).first()
    if not width:
        none = {"component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
        return x.where("false").select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    x = x.where(F.size("x") == width)
    machine = fit(x, components)
    keyed = x.select(F.col("vec_id").cast("string"), "x", deviation_of(F.col("x"), machine, largest).alias("deviation"))
    explained = F.array(*[F.lit(float(e)) for e in machine.explained])
    out = whitened_of(keyed, machine).select(F.col("vec_id").cast(kind).alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(machine.n).cast("bigint").alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), F.lit(machine.identity_error).alias("identity_error"))
