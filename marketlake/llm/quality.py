"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

Evidence: the shape of a whole text (distinct words, word length, capitals,
digits, symbols, line ends) is measured once for every document, cut into bins
and read by a logistic model.  All labelled rows that are not held out make the
bins (counts of fine steps of a measure give its quantiles) and the model: each
of Newton's steps sums slopes and curvatures over all of them on the executors.
The driver gets those sums alone, as whole numbers, so their order makes no
difference; it solves for the next weights.

Sites: the evidence of all documents is summed by path and by host in one
grouped aggregation (partial sums before the shuffle, so a host with a third of
all rows sends a row for each task).  A path's mean is shrunk towards its
host's posterior and a host's towards the global mean.  The strengths of both
priors are estimated from the spread between the groups by the method of
moments, so a site with few documents says little and one with many speaks for
itself.  A document's score adds the path's log-odds over the global ones to
those of its evidence.

Defined cases: a null text is empty; a null host or path part is a site of its
own; labels other than 0 and 1 are no examples; with examples of one class or
none the evidence is that class's share (0.5 without any); repeated rows count
each; a null doc_id is scored and counts as held out; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import sub_batches, texts_of
from .toxicity import in_fold, marked_rows

BINS, DECAY = 12, 1e-3
#: Newton's steps: their number and longest change of a weight, and the change below which they end.
STEPS, LONGEST, CLOSE = 40, 4.0, 1e-4
#: Units of a sum over rows, and steps of a measure.
UNIT, FINE = 1 << 24, 256
#: Bounds of a prior's strength, in documents.
STRENGTHS = (1.0, 1e6)
LEAST = 1e-3

_CAPITAL, _DIGIT, _LETTER, _SPACE = (np.zeros(256, bool) for _ in range(4))
_CAPITAL[65:91] = _DIGIT[48:58] = _SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def shape(text: bytes) -> list[float]:
    """Shares that describe a text, each 0 for an empty one but the last, its number of words (log)."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars, n = max(1, int(counts.sum() - counts[0x80:0xC0].sum())), max(1, len(words))
    capitals, digits, letters, spaces = (int(counts[m].sum()) for m in (_CAPITAL, _DIGIT, _LETTER, _SPACE))
    symbols = int(counts.sum()) - letters - digits - spaces
    return [len(set(words)) / n, (len(text) - spaces) / n, capitals / chars, digits / chars, symbols / chars, int(counts[10]) / n, float(np.log1p(len(words)))]


def steps_of(shapes: np.ndarray) -> np.ndarray:
    """Measures as whole steps, even in the log of 1 + 1024 x: below 6,000 for any measure a text may have."""
    return np.floor(FINE * np.log1p(1024 * shapes)).astype(np.int32)


SHAPE_SCHEMA = "doc_id long, steps array<int>, host string, path string"


def measure(docs: DataFrame) -> DataFrame:
    """The steps of each row of (doc_id, text, host, path); no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            steps = steps_of(np.array([shape(t) for t in texts_of(batch.column(1))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(steps), pa.list_(pa.int32())), batch.column(2), batch.column(3)], ["doc_id", "steps", "host", "path"])

    return docs.select("doc_id", "text", "host", "path").mapInArrow(rows, SHAPE_SCHEMA)


def _steps(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


class Evidence:
    """A logistic model over binned shapes; without both classes the constant share."""

    def __init__(self, examples: DataFrame):
        """Fit to all rows of (steps, zeros, ones)."""
        zeros, ones = (v or 0 for v in examples.agg(F.sum("zeros"), F.sum("ones")).first())
        self.share = ones / (zeros + ones) if zeros + ones else 0.5
        self.constant = not zeros or not ones
        if self.constant:
            return
        self.edges = _edges(examples)
        self.weights, self.offset = np.zeros((len(self.edges), BINS)), 0.0
        for _ in range(STEPS):
            slope, curve = self._sums(examples)
            slope, curve = slope / (zeros + ones), curve / (zeros + ones)
            slope[:-1] += DECAY * self.weights.ravel()
            curve[np.arange(len(slope) - 1), np.arange(len(slope) - 1)] += DECAY
            curve[-1, -1] += 1e-9
            change = np.linalg.solve(curve, slope)
            furthest = np.abs(change).max()
            change *= min(1.0, LONGEST / max(furthest, 1e-300))
            self.weights -= change[:-1].reshape(self.weights.shape)
            self.offset -= change[-1]
            if furthest < CLOSE:
                break

    def _cells(self, steps: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, steps[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def _sums(self, examples: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all rows of the loss's first and second derivatives by the weights and the offset."""
        size = self.weights.size + 1
        sent = examples.sparkSession.sparkContext.broadcast(self)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, total = sent.value, np.zeros((size, size + 1))
            for batch in batches:
                if not batch.num_rows:
                    continue
                steps, zeros, ones = _steps(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                cells = model._cells(steps)
                x = np.zeros((len(steps), size))
                x[np.arange(len(steps))[:, None], cells + BINS * np.arange(cells.shape[1])] = 1
                x[:, -1] = 1
                p, n = model._sigmoid(model._logits(cells)), zeros + ones
                total[:, :-1] += x.T @ (x * (n * p * (1 - p))[:, None])
                total[:, -1] += x.T @ (n * p - ones)
            units = np.rint(total.ravel() * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(units), dtype=np.int32)), pa.array(units)], ["place", "units"])

        total = np.zeros(size * (size + 1))
        for r in examples.mapInArrow(rows, "place int, units long").where("units <> 0").groupBy("place").agg(F.sum("units").alias("units")).collect():
            total[r.place] = r.units / UNIT
        total = total.reshape(size, size + 1)
        return total[:, -1], total[:, :-1]

    def _logits(self, cells: np.ndarray) -> np.ndarray:
        return self.weights[np.arange(cells.shape[1]), cells].sum(axis=1) + self.offset

    @staticmethod
    def _sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-z))

    def score(self, steps: np.ndarray) -> np.ndarray:
        return np.full(len(steps), self.share) if self.constant else self._sigmoid(self._logits(self._cells(steps)))


def _edges(examples: DataFrame) -> list[np.ndarray]:
    """The steps at which each measure is cut, by its quantiles over all rows."""
    counted = (examples.select(F.posexplode("steps").alias("k", "step"), (F.col("zeros") + F.col("ones")).alias("n"))
               .groupBy("k", "step").agg(F.sum("n").alias("n")).orderBy("k", "step").collect())
    k, step, n = np.array([tuple(r) for r in counted], np.int64).T
    out = []
    for measure_ in range(k.max() + 1):
        mine = k == measure_
        share = np.cumsum(n[mine]) / n[mine].sum()
        out.append(np.unique(step[mine][np.searchsorted(share, np.linspace(0, 1, BINS + 1)[1:-1] - 1e-12)]))
    return out


EVIDENCE_SCHEMA = "doc_id long, evidence double, host string, path string"


def score_evidence(shapes: DataFrame, model: Evidence) -> DataFrame:
    """The evidence of each row of (doc_id, steps, host, path); no shuffle."""
    sent = shapes.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                evidence = pa.array(sent.value.score(_steps(batch.column(1))), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), evidence, batch.column(2), batch.column(3)], ["doc_id", "evidence", "host", "path"])

    return shapes.mapInArrow(rows, EVIDENCE_SCHEMA)


def _strength(groups: DataFrame, n: str, mean: str, around: str) -> float:
    """A Beta prior's strength, by moments: what the groups' means vary beyond what their sizes explain."""
    m = F.col(around)
    spread, noise, total, square = groups.agg(
        F.sum(F.col(n) * (F.col(mean) - m) ** 2), F.sum(m * (1 - m)), F.sum(n), F.sum(F.col(n) * F.col(n))).first()
    if not total or total <= square / total:
        return STRENGTHS[1]
    count = groups.count()
    between = max(0.0, (spread - noise) / (total - square / total))
    inside = noise / count
    return STRENGTHS[1] if between <= 0 else float(np.clip(inside / between - 1, *STRENGTHS))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior) of every site, and the global mean."""
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")).withColumn("mean", F.col("s") / F.col("n"))
    whole = paths.agg(F.sum("s") / F.sum("n")).first()[0]
    overall = float(np.clip(0.5 if whole is None else whole, LEAST, 1 - LEAST))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    hosts = hosts.withColumns({"host_mean": F.col("host_s") / F.col("host_n"), "overall": F.lit(overall)})
    strength = _strength(hosts, "host_n", "host_mean", "overall")
    hosts = hosts.withColumn("host_posterior", (F.col("host_s") + strength * overall) / (F.col("host_n") + strength))
    joined = paths.join(hosts.select("host", "host_posterior"), "host")
    strength = _strength(joined, "n", "mean", "host_posterior")
    posterior = (F.col("s") + strength * F.col("host_posterior")) / (F.col("n") + strength)
    return joined.select("host", "path", "host_posterior", posterior.alias("path_posterior")), overall


def _log_odds(share) -> F.Column:
    clipped = F.least(F.greatest(share, F.lit(LEAST)), F.lit(1 - LEAST))
    return F.log(clipped / (1 - clipped))


def classify(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_cols: Sequence[str] = ("lang",), label: str = "quality",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, evidence, host_posterior, path_posterior, score, keep for every row."""
    spark = docs.sparkSession
    host = F.coalesce(docs[host_col].cast("string"), F.lit(""))
    path = F.concat_ws("/", host, *[F.coalesce(docs[c].cast("string"), F.lit("")) for c in path_cols])
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), host.alias("host"), path.alias("path"))
    measured, written = scratch_path(spark, "shapes"), scratch_path(spark, "evidence")
    measure(plain).write.parquet(measured)
    shapes = spark.read.schema(SHAPE_SCHEMA).parquet(measured)
    examples = shapes.join(marked_rows(labels, label), "doc_id").select("steps", "zeros", "ones")
    kept = scratch_path(spark, "labelled-shapes")
    examples.write.parquet(kept)
    score_evidence(shapes, Evidence(spark.read.schema("steps array<int>, zeros long, ones long").parquet(kept))).write.parquet(written)
    evidence = spark.read.schema(EVIDENCE_SCHEMA).parquet(written)
    sites, overall = site_posteriors(evidence)
    odds = _log_odds(F.col("evidence")) + _log_odds(F.col("path_posterior")) - _log_odds(F.lit(overall))
    return evidence.join(sites, ["host", "path"]).select(
        "doc_id", F.coalesce(in_fold(F.col("doc_id")), F.lit(True)).alias("held_out"), "evidence", "host_posterior", "path_posterior",
        (1 / (1 + F.exp(-odds))).alias("score"), (odds >= 0).alias("keep"))
