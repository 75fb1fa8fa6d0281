"""Quality scores: ridge regression on random Fourier features, calibrated isotonically.

Every text gets a short vector of statistics (byte classes, entropy, word and line
repetition).  Random Fourier features of the standardised vector approximate a Gaussian
kernel.  Each partition sums its share of the normal equations per fold; the sums, whose
size depends on the number of features alone, are added in a second stage and solved on
the driver.  Each fold's rows are scored by the solution of the other folds; their scores
and labels, summed in ``BINS`` bins, give the isotonic calibration.  No label, language,
source or id enters a score.

All labelled rows outside the held-out fifth take part; there is no sample.  Several
labels of a document are averaged.

Edge cases: null, empty and blank texts have the statistics of an empty text and a score
like any other; null labels and labels of unknown documents are left out; without any
label every score is 0.5; a document that stands in several rows is scored in each of
them; a null doc_id counts as held out; a table without rows gives none; other columns
pass through ``scored`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import released, ship, written
from lakehand.llm.words import window_hashes, word_slices

#: Random features of the kernel.
FEATURES = 256
#: Width of the Gaussian kernel, in standard deviations of the statistics' distance.
SIGMA = 1.0
RIDGE = 1e-3
#: Bins of the calibration over raw scores from LOW to HIGH.
BINS, LOW, HIGH = 2000, -0.5, 1.5
FOLDS = 5
THRESHOLD = 0.3
_SEED = 17
_CLIP = 6.0

_SYMBOLS = b"#*$%&|<>@^~=+_\\/{}[]"
_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "symbol": _SYMBOLS,
    "stop": b".", "comma": b",;:", "bang": b"!?", "quote": b"\"'()-", "line": b"\n", "space": b" \t\r\x0b\x0c",
    "high": bytes(range(128, 256)),
}
STATS = [*_CLASSES, "entropy", "log_words", "word_bytes", "distinct", "repeat3", "dup_lines", "line_words", "short_lines"]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATS per text."""
    table = np.zeros((256, len(_CLASSES)))
    for k, chars in enumerate(_CLASSES.values()):
        table[list(chars), k] = 1
    raw = texts.cast(pa.large_binary()).to_pylist()
    out = np.zeros((len(raw), len(STATS)))
    c = len(_CLASSES)
    for lo, to, words, offs in word_slices(texts):
        grams = window_hashes(words, 3)
        for i in range(lo, to):
            text = raw[i] or b""
            if not text:
                continue
            hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            share = hist[hist > 0] / len(text)
            own = words[offs[i - lo]:offs[i - lo + 1]]
            n = len(own)
            g = grams[offs[i - lo]:max(offs[i - lo], offs[i - lo + 1] - 2)]
            lines = [x for x in text.split(b"\n") if x]
            out[i, :c] = hist @ table / len(text)
            out[i, c:] = (-(share * np.log2(share)).sum(), np.log1p(n), min(len(text) / max(n, 1), 50),
                          len(np.unique(own)) / max(n, 1) ** 0.75, 1 - len(np.unique(g)) / max(len(g), 1),
                          1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)),
                          sum(len(x) < 40 for x in lines) / max(len(lines), 1))
    return out


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features of standardised statistics, and a constant."""
    rng = np.random.default_rng(_SEED)
    dims = stats.shape[1]
    omega = rng.normal(0, 1 / (SIGMA * np.sqrt(dims)), (dims, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -_CLIP, _CLIP)
    z = np.sqrt(2 / FEATURES) * np.cos(x @ omega + phase)
    return np.hstack([z, np.ones((len(z), 1))])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    at: np.ndarray
    value: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        # A hundredth of the raw score keeps the order inside a calibrated step.
        return np.clip(0.99 * np.interp(raw, self.at, self.value) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def isotonic(at: np.ndarray, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order: mean position and mean label of every block."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at * n, total, n, strict=True):
        blocks.append([x, y, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


@released
def stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, stats.T)], ["doc_id", *STATS])


def fold_column():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy() for c in STATS])


def equation_rows(mean: np.ndarray, scale: np.ndarray):
    """Per partition and fold the rows of ``[Z'Z | Z'y]``."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z, y = fourier(_matrix(batch), mean, scale), batch.column("label").to_numpy()
            fold = batch.column("fold").to_numpy()
            for f in range(1, FOLDS):
                own = z[fold == f]
                total[f] += own.T @ np.column_stack([own, y[fold == f]])
        rows = [(f, i, total[f, i]) for f in range(1, FOLDS) for i in range(FEATURES + 1) if total[f].any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["fold", "i", "row"])
    return sums


def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        rows = np.stack(batch.column("row").to_numpy(zero_copy_only=False))
        for key, row in zip(zip(batch.column("fold").to_pylist(), batch.column("i").to_pylist()), rows):
            total[key] = total.get(key, 0) + row
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                                          pa.array(list(total.values()), pa.list_(pa.float64()))], ["fold", "i", "row"])


def bin_rows(models: dict[int, Model]):
    """Calibration bins of the rows' out-of-fold scores."""
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats, fold = _matrix(batch), batch.column("fold").to_numpy()
            raw = np.zeros(len(fold))
            for f, m in models.items():
                raw[fold == f] = m.raw(stats[fold == f])
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], ["bin", "label"])
    return bins


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``stats`` (doc_id, STATS) that ``labels`` (doc_id, label) marks and no fold 0 holds."""
    moments = stats.agg(*[F.avg(c).alias("m_" + c) for c in STATS], *[F.stddev_pop(c).alias("s_" + c) for c in STATS]).first()
    mean = np.array([moments["m_" + c] or 0.0 for c in STATS])
    scale = np.array([max(moments["s_" + c] or 0.0, 1e-6) for c in STATS])
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    train = stats.join(labels, "doc_id").withColumn("fold", fold_column()).where("fold > 0").select(*STATS, "label", "fold")
    schema = "fold int, i int, row array<double>"
    added = (train.mapInArrow(equation_rows(mean, scale), schema).repartition("i").mapInArrow(add_rows, schema)).collect()
    total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
    for r in added:     # FOLDS * (FEATURES + 1) rows, whatever the input
        total[r["fold"], r["i"]] += r["row"]
    if not added:
        return Model(mean, scale, None, np.zeros(1), np.zeros(1))

    def solve(t: np.ndarray) -> Model:
        n = t[-1, -2]
        return Model(mean, scale, np.linalg.solve(t[:, :-1] + RIDGE * n * np.eye(len(t)) / FEATURES, t[:, -1]), np.zeros(1), np.zeros(1))

    whole = total.sum(axis=0)
    folds = {f: solve(whole - total[f] if (whole - total[f])[-1, -2] > 0 else whole) for f in range(1, FOLDS)}
    bins = sorted(train.mapInArrow(bin_rows(folds), "bin int, label double").groupBy("bin")
                  .agg(F.sum("label").alias("y"), F.count("*").alias("n")).collect())     # BINS rows at most
    b = np.array([[r["bin"], r["y"], r["n"]] for r in bins], float)
    model = solve(whole)
    model.at, model.value = isotonic(LOW + (b[:, 0] + 0.5) * (HIGH - LOW) / BINS, b[:, 1], b[:, 2])
    return model


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of every row, written once."""
    ship(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long"), "text")
                   .mapInArrow(stat_rows, ", ".join(["doc_id long", *[f"{c} double" for c in STATS]])), "stats")


def quality_labels(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))


def score_stats(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), pa.array(score)],
                                             ["doc_id", "fold", "score"])
    return rows


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    stats = document_stats(docs)
    model = fit(stats, quality_labels(labels))
    return (stats.withColumn("fold", fold_column())
            .mapInArrow(score_stats(model), "doc_id long, fold int, score double")
            .select("doc_id", (F.col("fold") == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score for each row, all columns kept; the text is neither joined nor shuffled."""
    @released
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])
    ship(docs.sparkSession)
    return docs.mapInArrow(rows, docs.withColumn(name, F.lit(0.0)).schema)
