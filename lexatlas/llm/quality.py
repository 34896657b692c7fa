"""Quality classification by positive-unlabelled learning.

Trusted positives are the rows labelled 1; all other labels stay unread. Every row, whatever its label, is unlabelled web text. A linear
score g over the features of a text minimises the non-negative unbiased risk

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)]) + RIDGE / 2 |w|^2,    l(z) = log(1 + exp(-z)),

where pi is the class prior. Since l(z) - l(-z) = -z, both arguments of the maximum give convex risks, and so does every mixture

    J_s = pi E_p[(1 - s) l(g) - s g] + s E_u[l(-g)],    0 <= s <= 1.

If the minimum of J_1, the unbiased risk, has a non-negative part for negatives, it is the answer. Else the minimum lies where that part is
zero: s is bisected, each J_s is minimised by Newton steps from the last one's minimum.

The prior is estimated first: a classifier of positives against unlabelled rows is fitted on two thirds of the positives, by hash of their
text. Over all thresholds c the ratio of the parts of unlabelled rows and of the kept third of positives that score c or more bounds the prior from
above; the ratio at the threshold where its confidence bound is lowest is the estimate (best bin estimation).

All rows take part in each step: features are laid down once, tasks add up losses, gradients and curvatures of their rows, and these
sums, of fixed size, meet in groups (see folding). Nothing is sampled. Features are shares of classes of characters and of hashed pairs of
classes, shares of distinct words and lines (in blocks of BLOCK characters, so that long texts take bounded memory), lengths; all of
the text, nothing but the text.

Edge cases: a null text is empty, and has a score as any other. Repeated rows count each. A doc_id whose labels differ is no positive; one
with a null id is held out and learned from by nobody. Without positives or rows to learn from, all scores are 0.5. Other
columns may have any names; the labels' other columns stay unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm.common import name, ready_python, staged, table
from lexatlas.llm.folding import summed
from lexatlas.llm.uneven import HOT_ROWS, hot_keys, join_dealt

BLOCK = 1 << 20
CLASSES, PAIRS = 40, 96
FEATURES = CLASSES + PAIRS + 6
RIDGE = 1e-2
NEWTON_STEPS, BISECTIONS = 12, 7
BINS, CONFIDENCE = 1000, 0.1
_pair_bin = ((np.arange(CLASSES * CLASSES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % PAIRS
_classes: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """The class of each code point: upper case, space, line end, digit, other letter, the ASCII marks one by one, others."""
    if not _classes:
        marks = {c: k + 5 for k, c in enumerate(c for c in map(chr, range(33, 127)) if not c.isalnum())}
        kind = lambda c: 2 if c == "\n" else 1 if c.isspace() else 3 if c.isdigit() else 0 if c.isupper() else 4 if c.isalpha() else marks.get(c, CLASSES - 1)
        _classes.append(np.fromiter((kind(chr(c)) for c in range(0x110000)), np.int64, 0x110000))
    return _classes[0]


def features(text: str | None) -> np.ndarray:
    text = text or ""
    classes, one, two = character_classes(), np.zeros(CLASSES), np.zeros(CLASSES * CLASSES)
    words = distinct = lines = fresh = 0
    last = np.zeros(0, np.int64)
    for k in range(0, len(text), BLOCK):
        part = text[k : k + BLOCK]
        here = classes[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        one += np.bincount(here, minlength=CLASSES)
        here = np.concatenate([last, here])
        two += np.bincount(here[:-1] * CLASSES + here[1:], minlength=CLASSES * CLASSES)
        last = here[-1:]
        w, x = part.split(), part.split("\n")
        words, distinct, lines, fresh = words + len(w), distinct + len(set(w)), lines + len(x), fresh + len(set(x))
    n = max(1, len(text))
    shape = [distinct / max(1, words), fresh / max(1, lines), math.log1p(len(text)) / 10, math.log1p(words) / 10, min(1.0, n / max(1, words) / 20), float(not text)]
    return np.concatenate([np.sqrt(one / n), np.sqrt(np.bincount(_pair_bin, weights=two / n, minlength=PAIRS)), shape])


def packed_features(text: Column) -> Column:
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t).astype("<f2").tobytes() for t in texts], dtype=object)

    return run(text.cast("string"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f2").reshape(-1, FEATURES).astype(float)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Scale:
    """Features in units of their spread, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        self.mean, self.spread = mean, spread

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])


def _add(values: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(v) for v in values], axis=0).tobytes()


def scale_of(rows: DataFrame) -> Scale:
    def each(batches: Iterator[pa.RecordBatch]) -> bytes:
        out = np.zeros(2 * FEATURES + 1)
        for b in batches:
            x = matrix(b.column("f"))
            out += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
        return out.tobytes()

    t = np.frombuffer(summed(rows.select("f"), each, _add))
    mean = t[1 : FEATURES + 1] / max(1.0, t[0])
    return Scale(mean, np.maximum(np.sqrt(np.maximum(0, t[FEATURES + 1 :] / max(1.0, t[0]) - mean**2)), 1e-3))


class Moments:
    """Sums over rows at some weights: of positives and of all rows the number, l(g), l(-g), sigmoid(g) z, z, and sigmoid'(g) z z'."""

    SIZE = FEATURES + 1

    def __init__(self, values: np.ndarray):
        d = self.SIZE
        for half, side in zip(values.reshape(2, -1), ("p", "u"), strict=True):
            n = max(1.0, half[0])
            setattr(self, f"n_{side}", half[0])
            setattr(self, side, {"plus": half[1] / n, "minus": half[2] / n, "slope": half[3 : 3 + d] / n, "z": half[3 + d : 3 + 2 * d] / n, "curve": half[3 + 2 * d :].reshape(d, d) / n})


def moments(rows: DataFrame, scale: Scale, w: np.ndarray) -> Moments:
    """rows: positive (whether a row counts as one), f."""

    def each(batches: Iterator[pa.RecordBatch]) -> bytes:
        out = [np.zeros(3 + 2 * Moments.SIZE + Moments.SIZE**2) for _ in range(2)]
        for b in batches:
            z = scale(matrix(b.column("f")))
            yes = np.array(b.column("positive").to_pylist(), bool)
            for side, x in zip(out, (z[yes], z), strict=True):
                g = x @ w
                s = sigmoid(g)
                side += np.concatenate([[len(x), np.logaddexp(0, -g).sum(), np.logaddexp(0, g).sum()], x.T @ s, x.sum(0), ((x.T * (s * (1 - s))) @ x).ravel()])
        return np.concatenate(out).tobytes()

    return Moments(np.frombuffer(summed(rows, each, _add)))


def risk(m: Moments, w: np.ndarray, a: float, b: float, c: float, ridge: float) -> tuple[float, np.ndarray, np.ndarray]:
    """a E_p[l(g)] - b E_p[g] + c E_u[l(-g)] + ridge / 2 |w|^2: value, gradient, curvature."""
    value = a * m.p["plus"] - b * (m.p["z"] @ w) + c * m.u["minus"] + ridge * (w @ w) / 2
    slope = a * (m.p["slope"] - m.p["z"]) - b * m.p["z"] + c * m.u["slope"] + ridge * w
    return value, slope, a * m.p["curve"] + c * m.u["curve"] + ridge * np.eye(len(w))


def minimise(rows: DataFrame, scale: Scale, w: np.ndarray, a: float, b: float, c: float, ridge: float, steps: int, m: Moments | None = None, until=None) -> tuple[np.ndarray, Moments]:
    """Newton steps, shortened until the risk falls, or until until() holds; each looks at all rows once."""
    m = m or moments(rows, scale, w)
    for _ in range(steps):
        value, slope, curve = risk(m, w, a, b, c, ridge)
        step, size = np.linalg.solve(curve, slope), 1.0
        if slope @ step < 1e-6 or until is not None and until(m):
            break
        while True:
            there = moments(rows, scale, w - size * step)
            if risk(there, w - size * step, a, b, c, ridge)[0] <= value or size < 1e-2:
                break
            size /= 4
        w, m = w - size * step, there
    return w, m


def class_prior(rows: DataFrame, scale: Scale, ridge: float = RIDGE) -> tuple[float, np.ndarray]:
    """(the part of positives among all rows, by best bin estimation; weights that tell positives from all rows). rows: positive, part (0: kept for
    the estimate), f."""
    fitted = rows.withColumn("positive", F.col("positive") & (F.col("part") != 0))
    w, _ = minimise(fitted, scale, np.zeros(Moments.SIZE), 0.5, 0.0, 0.5, ridge, NEWTON_STEPS // 2)

    def each(batches: Iterator[pa.RecordBatch]) -> bytes:
        out = np.zeros((2, BINS))
        for b in batches:
            at = np.minimum(BINS - 1, (sigmoid(scale(matrix(b.column("f"))) @ w) * BINS).astype(np.int64))
            kept = np.array(b.column("positive").to_pylist(), bool) & (np.array(b.column("part").to_pylist()) == 0)
            out += [np.bincount(at[kept], minlength=BINS), np.bincount(at, minlength=BINS)]
        return out.tobytes()

    p, u = np.frombuffer(summed(rows, each, _add)).reshape(2, BINS)[:, ::-1].cumsum(1)
    n_p, n_u = p[-1], u[-1]
    if not n_p or not n_u:
        return 0.5, w
    room = math.sqrt(math.log(4 / CONFIDENCE) / 2 / n_p) + math.sqrt(math.log(4 / CONFIDENCE) / 2 / n_u)
    some = p > 0
    q_p, q_u = p[some] / n_p, u[some] / n_u
    return float(np.clip((q_u / q_p)[np.argmin(q_u / q_p + room / q_p)], 0.01, 0.99)), w


class Model:
    """scale is None where nothing was learned."""

    def __init__(self, scale: Scale | None, w: np.ndarray, prior: float):
        self.scale, self.w, self.prior = scale, w, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 0.5) if self.scale is None else sigmoid(self.scale(x) @ self.w)


def train(rows: DataFrame, ridge: float = RIDGE) -> Model:
    """rows: positive, part, f; a stored table."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("p")).first()
    if not seen["p"]:
        return Model(None, np.zeros(Moments.SIZE), 0.5)
    scale = scale_of(rows)
    prior, start = class_prior(rows, scale, ridge)
    kept = rows.select("positive", "f")
    negative_part = lambda m: m.u["minus"] - prior * m.p["minus"]
    w, m = minimise(kept, scale, start, 0.0, prior, 1.0, ridge, NEWTON_STEPS, until=lambda m: negative_part(m) < 0)
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS if negative_part(m) < 0 else 0):
        s = (low + high) / 2
        w, m = minimise(kept, scale, w, prior * (1 - s), prior * s, s, ridge, NEWTON_STEPS // 2, m)
        low, high = (low, s) if negative_part(m) < 0 else (s, high)
    return Model(scale, w, prior)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def trusted(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """id of the rows all of whose labels are 1, of those to learn from."""
    seen = labels.select(F.col(name(id_col)).alias("id"), F.col(name(label_col)).alias("q")).where(~held_out(F.col("id")) & F.col("q").isNotNull())
    return seen.groupBy("id").agg(F.min("q").alias("least"), F.max("q").alias("most")).where("least = 1 and most = 1").select("id")


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", ridge: float = RIDGE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """id, held_out, score, prior (the estimate) of every row of docs."""
    ready_python(docs.sparkSession)
    text, key = F.col(name(text_col)), F.col(name(id_col))
    part = F.pmod(F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))), F.lit(3))
    seen = staged(docs.select(key.alias("id"), held_out(key).alias("held_out"), part.alias("part"), packed_features(text).alias("f")), "quality-features")
    learned = seen.where("not held_out").select("id", "part", "f")
    yes = trusted(labels, id_col, label_col).withColumnRenamed("id", "positive_id")
    rows = join_dealt(learned, yes, {"id": "positive_id"}, hot_keys(learned, ["id"], hot_rows), "left")
    model = train(staged(rows.select(F.col("positive_id").isNotNull().alias("positive"), "part", "f"), "quality-rows"), ridge)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for f in batches:
            yield pd.Series(shared.value.scores(matrix(pa.array(f, pa.binary()))), dtype=float)

    return seen.select("id", "held_out", scored("f").alias("score"), F.lit(model.prior).alias("prior"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "prior")
