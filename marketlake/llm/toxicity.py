"""Toxicity with a convolutional text classifier.

A word's embedding is the mean of hashed embeddings of the word and of its first
4, 5 and 6 characters, so inflected forms share weight.  Filters of widths 1, 2
and 3 slide over the whole text, each filter keeps its largest response, and a
logistic layer reads those.

Every labelled row that is not held out takes part.  Four fifths of them, by a
hash of the id, fit the parameters on the executors: in a round each task takes
the parameters of the last one, works through its own rows (ROUND_ROWS or so) in
small steps, and the tasks' changes are averaged; the rounds share the rows out,
so a large table is gone through once and a small one (SMALL rows) many times by
one task.  The last fifth is scored, and counts of its logits set the thresholds
by language.  What passes the driver is the parameters and those counts, whose
sizes do not depend on the rows.  Changes are summed as whole numbers, so the
order of the tasks makes no difference.

The language is guessed from function words of the text; the lang column, the
source, the id and the labels are never inputs of a score.  A score of 0.5 is
the language's threshold.

Defined cases: a null or empty text is scored like a text of padding; a null
label is no example; repeated labels of a document count once each; without an
example of either class to fit on every score is 0.0 and nothing is predicted toxic;
repeated rows get equal scores, one row each; a null doc_id is scored and
counts as held out by its null remainder (never trained on); an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, sub_batches, texts_of

FOLDS = 5
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 12, 8, (1, 2, 3)
STEPS, BATCH, RATE, DECAY, SEED = 300, 32, 0.01, 1e-4, 7
#: Rows that one task fits alone; beyond them rows are dealt to ROUNDS rounds and tasks of ROUND_ROWS.
SMALL, ROUNDS, ROUND_ROWS = STEPS * BATCH, 4, 2048
#: Rows and bytes of text that a task holds while it goes through them.
HELD_ROWS, HELD_BYTES = 2 * SMALL, 48 << 20
#: Buckets in a piece of the embedding, units of a change of a parameter, and steps of a logit that thresholds tell apart.
PIECE, UNIT, FINE, FARTHEST = 1 << 12, 1 << 24, 64, 1 << 12
PADS = max(WIDTHS) - 1
#: Labels of each class that a threshold of its own takes.
LEAST_MARKS = 5
#: Words whose responses a task holds (some 600 bytes each).
MEMO_WORDS = 100_000
CHUNK = 1 << 20

# Frequent function words by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on with as was this are from they".split(),
    "de": "der die und das den ist mit von für auf nicht ein eine sich im dem".split(),
    "fr": "le les des et une dans est pour qui sur par avec au du pas la que de".split(),
    "es": "el los las del y en un por con para es se no lo como la que de".split(),
}

_WORD = re.compile(r"\w+")
_LANGUAGES: dict[str, list[int]] = {}
for _n, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in _words:
        _LANGUAGES.setdefault(_w, []).append(_n)


def words_of(text: bytes) -> list[str]:
    return _WORD.findall(text.decode().lower())


def features(word: str) -> list[int]:
    """Buckets of the word and its beginnings."""
    return [xxhash.xxh32_intdigest(f"{n}:{p}") % BUCKETS for n, p in enumerate((word, word[:4], word[:5], word[:6]))]


def ballots(words: list[str]) -> np.ndarray:
    """For each word 1 for each language whose function word it is; a last row of zeros is padding."""
    out = np.zeros((len(words) + 1, len(FUNCTION_WORDS)), np.int32)
    for k, w in enumerate(words):
        for n in _LANGUAGES.get(w, ()):
            out[k, n] = 1
    return out


def languages(ballots: np.ndarray, stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Number of the language with most function words in each document; one past the last if none has any."""
    votes = np.add.reduceat(ballots[stream], begin, axis=0)
    return np.where(votes.any(axis=1), votes.argmax(axis=1), votes.shape[1])


@dataclass
class Model:
    embedding: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # for each width: DIM x (width * FILTERS), place by place
    bias: np.ndarray  # of the filters
    weight: np.ndarray
    offset: float
    thresholds: np.ndarray  # by language

    def responses(self, buckets: np.ndarray) -> np.ndarray:
        """By place of every width: what each word (a row of buckets) adds to the filters; a last row of zeros is padding."""
        vectors = self.embedding[buckets].mean(axis=1)
        rows = np.concatenate([vectors @ f for f in self.filters], axis=1)
        padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)])
        return np.ascontiguousarray(padded.reshape(len(padded), -1, FILTERS).swapaxes(0, 1))

    def pooled(self, table: np.ndarray, stream: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest responses of each document in a stream of padded documents; and the windows' responses by width."""
        out, all_windows, places = [], [], iter(table)
        for width in WIDTHS:
            windows = next(places).take(stream, axis=0)
            for place in range(1, width):
                windows[:-place] += next(places).take(stream[place:], axis=0)
            out.append(np.maximum.reduceat(windows, begin, axis=0))
            all_windows.append(windows)
        return np.maximum(np.concatenate(out, axis=1) + self.bias, 0), all_windows

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weight + self.offset


def _stream(docs: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents end to end, each followed by padding that no window crosses; their starts."""
    tail = np.full(PADS, pad)
    sizes = np.array([len(d) + PADS for d in docs])
    return np.concatenate([x for d in docs for x in (d, tail)]).astype(np.int64), np.cumsum(sizes) - sizes


def _fresh_params(bias: float) -> list[np.ndarray]:
    rng = np.random.default_rng(SEED)
    shapes = [(BUCKETS, DIM), *[(DIM, w * FILTERS) for w in WIDTHS], (FILTERS * len(WIDTHS),), (FILTERS * len(WIDTHS),), (1,)]
    params = [rng.normal(0, 0.1 if k == 0 else 0.3, s).astype(np.float32) for k, s in enumerate(shapes)]
    params[-3][:] = 0  # the filters' bias
    params[-2][:] = np.abs(params[-2])  # a filter speaks for the class at first
    params[-1][:] = bias
    return params


class _Fit:
    """Parameters under Adam; rows of the embedding move only in steps that reach them."""

    def __init__(self, params: list[np.ndarray], weights: tuple[float, float]):
        self.params, self.weights, self.step = [p.copy() for p in params], weights, 0
        self.moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
        self.touched = np.zeros(BUCKETS, bool)

    def run(self, texts: list[bytes], counts: np.ndarray, passes: int, rng: np.random.Generator) -> None:
        """Go through the texts ``passes`` times; ``counts`` has each text's labels of 0 and of 1."""
        numbers = _Words()
        docs = [np.array([numbers[w] for w in words_of(t)], np.int64) for t in texts]
        buckets = np.array(numbers.buckets, np.int64).reshape(-1, 4)
        both = counts * np.array(self.weights)
        for _ in range(passes):
            order = rng.permutation(len(docs))
            for batch in np.array_split(order, max(1, len(docs) // BATCH)):
                self._batch([docs[d] for d in batch], both[batch], buckets)

    def _batch(self, docs: list[np.ndarray], both: np.ndarray, buckets: np.ndarray) -> None:
        self.step += 1
        model = _model(self.params)
        used, local = np.unique(np.concatenate(docs).astype(np.int64), return_inverse=True)
        stream, begin = _stream(np.split(local, np.cumsum([len(d) for d in docs])[:-1]), len(used))
        pooled, windows = model.pooled(model.responses(buckets[used]), stream, begin)
        error = ((both.sum(axis=1) / (1 + np.exp(-model.logits(pooled))) - both[:, 1]) / len(docs)).astype(np.float32)
        rows, slope, *grads = _gradients(model, pooled, windows, stream, begin, error, buckets[used])
        self.touched[rows] = True
        for k, g in enumerate([slope, *grads]):
            at = rows if k == 0 else slice(None)
            p, (m, v) = self.params[k], self.moments[k]
            g = g + DECAY * p[at]
            m[at] += 0.1 * (g - m[at])
            v[at] += 0.01 * (g * g - v[at])
            p[at] -= RATE * (m[at] / (1 - 0.9**self.step)) / (np.sqrt(v[at] / (1 - 0.99**self.step)) + 1e-6)


DELTA_SCHEMA = "piece int, change binary, tasks binary"


def _changes(before: list[np.ndarray], fit: _Fit) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A fit's changes in whole units, piece by piece of the embedding and then (piece -1) all
    else; and for each row of a piece whether the fit reached it."""
    for piece in range(BUCKETS // PIECE):
        rows = slice(piece * PIECE, (piece + 1) * PIECE)
        if fit.touched[rows].any():
            yield piece, np.rint((fit.params[0][rows] - before[0][rows]) * UNIT).astype(np.int32).ravel(), fit.touched[rows].astype(np.int8)
    rest = [np.concatenate([p.ravel() for p in ps[1:]]) for ps in (before, fit.params)]
    yield -1, np.rint((rest[1] - rest[0]) * UNIT).astype(np.int32), np.ones(1, np.int8)


def _sum_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            found = [np.frombuffer(r[c], t).astype(np.int64) for c, t in (("change", np.int32), ("tasks", np.int8))]
            sums[r["piece"]] = [a + b for a, b in zip(sums[r["piece"]], found)] if r["piece"] in sums else found
    for piece, (change, tasks) in sums.items():
        yield _delta_batch(piece, change, tasks)


def _delta_batch(piece: int, change: np.ndarray, tasks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([change.tobytes()], pa.binary()), pa.array([tasks.tobytes()], pa.binary())], ["piece", "change", "tasks"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Texts and counts of labels of (text, zeros, ones), as many as a task may hold."""
    texts, counts, size = [], [], 0
    for batch in sub_batches(batches, 0, CHUNK):
        for text, *n in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            texts.append(text)
            counts.append(n)
            size += len(text)
        if len(texts) >= HELD_ROWS or size >= HELD_BYTES:
            yield texts, np.array(counts, float)
            texts, counts, size = [], [], 0
    if texts:
        yield texts, np.array(counts, float)


def fit_round(examples: DataFrame, params: list[np.ndarray], weights: tuple[float, float], passes: int, round_: int) -> list[np.ndarray]:
    """The parameters after each partition of ``examples`` (as _labelled takes them) has gone through its
    labelled rows from ``params``: the mean of the partitions' changes, for a row of the embedding of those that reached it."""
    spark = examples.sparkSession
    sent = spark.sparkContext.broadcast(params)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, rng = _Fit(sent.value, weights), np.random.default_rng([SEED, round_])
        for texts, counts in _held(_labelled(batches)):
            fit.run(texts, counts, passes, rng)
        if fit.step:
            for change in _changes(sent.value, fit):
                yield _delta_batch(*change)

    sums = examples.mapInArrow(work, DELTA_SCHEMA).repartition("piece").mapInArrow(_sum_changes, DELTA_SCHEMA).collect()
    out = [p.copy() for p in params]
    for r in sums:
        change, tasks = (np.frombuffer(r[c], np.int64) for c in ("change", "tasks"))
        if r.piece >= 0:
            rows = slice(r.piece * PIECE, (r.piece + 1) * PIECE)
            out[0][rows] += (change.reshape(PIECE, DIM) / (UNIT * np.maximum(tasks, 1)[:, None])).astype(np.float32)
        else:
            at = 0
            for p in out[1:]:
                p += (change[at : at + p.size] / (UNIT * tasks[0])).astype(np.float32).reshape(p.shape)
                at += p.size
    sent.unpersist()
    return out


LOGIT_SCHEMA = "spoken int, step int, zeros long, ones long"


def logit_counts(examples: DataFrame, model: Model) -> DataFrame:
    """(spoken, step, zeros, ones): labels of the rows of each language and step of the logit; ``examples`` as in fit_round."""
    sent = examples.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(sent.value)
        for batch in sub_batches(_labelled(batches), 0, CHUNK):
            logits, spoken = scorer.score(texts_of(batch.column(0)))
            steps = np.clip(np.floor(logits * FINE), -FARTHEST, FARTHEST).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(spoken.astype(np.int32)), pa.array(steps), batch.column(1), batch.column(2)], ["spoken", "step", "zeros", "ones"])

    return examples.mapInArrow(work, LOGIT_SCHEMA).groupBy("spoken", "step").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, zeros, ones) with the labels of their document, which come before them in order of doc_id.

    The tasks call it inside their own work: a Python operator of its own would be a
    second Python worker for each core, which an executor keeps for all later stages."""
    last = None
    for batch in sub_batches(batches, 1, CHUNK):
        ids, known = batch.column(0).to_numpy(), batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        zeros, ones = (batch.column(c).fill_null(0).to_numpy() for c in (2, 3))
        if last is not None:
            ids, known, zeros, ones = (np.concatenate([[x], y]) for x, y in zip(last, (ids, known, zeros, ones)))
        at = np.maximum.accumulate(np.where(known, np.arange(len(ids)), -1))
        rows = np.flatnonzero(~known & (at >= 0) & (ids[at] == ids))
        if len(rows):
            of = at[rows]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(rows - (len(ids) - batch.num_rows))), pa.array(zeros[of]), pa.array(ones[of])], ["text", "zeros", "ones"])
        last = (ids[at[-1]], True, zeros[at[-1]], ones[at[-1]]) if at[-1] >= 0 else None


def train(docs: DataFrame, labels: DataFrame, label: str) -> Model | None:
    """Fit on all rows of (doc_id, text) with a label of 0 or 1 that are not held out, a fifth of
    them left for the thresholds; without both classes None."""
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS * ROUNDS)).cast("int").alias("fold")
    marked = marked_rows(labels, label).withColumn("fold", fold)
    # Folds of the fifth for the thresholds come last.
    to_fit = F.col("fold") < (FOLDS - 1) * ROUNDS
    n, zeros, ones = (v or 0 for v in marked.where(to_fit).agg(F.count("*"), F.sum("zeros"), F.sum("ones")).first())
    if not zeros or not ones:
        return None
    weights = ((zeros + ones) / (2 * zeros), (zeros + ones) / (2 * ones))
    rounds = ROUNDS if n > SMALL else 1
    tasks, passes = (-(-n // (rounds * ROUND_ROWS)), 1) if rounds > 1 else (1, -(-SMALL // n))

    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.lit(None).cast("long").alias("zeros"), F.lit(None).cast("long").alias("ones"), fold)
    both = marked.select("doc_id", F.lit(None).cast("string").alias("text"), "zeros", "ones", "fold").unionAll(texts)

    def examples(of: Column, parts: int) -> DataFrame:
        # One shuffle to as many tasks as named (a join may choose another number): a document's labels come before its rows.
        mine = both.where(of).drop("fold").repartition(parts, "doc_id")
        return mine.sortWithinPartitions("doc_id", F.col("zeros").asc_nulls_last(), F.xxhash64("text"), "text")

    params = _fresh_params(-1.0)
    for k in range(rounds):
        params = fit_round(examples(to_fit & (F.col("fold") % rounds == k), tasks), params, weights, passes, k)
    model = _model(params)
    model.thresholds = _thresholds(logit_counts(examples(~to_fit, tasks), model).collect())
    return model


def _model(params: list[np.ndarray]) -> Model:
    return Model(params[0], params[1:-3], params[-3], params[-2], float(params[-1][0]), np.zeros(len(FUNCTION_WORDS) + 1))


def _gradients(model, pooled, windows, stream, begin, error, buckets) -> list[np.ndarray]:
    """Gradients of the parameters, of the embedding as (rows, their gradients); the loss reaches the text only at each filter's best window."""
    ends = np.append(begin[1:], len(stream))
    back = error[:, None] * model.weight * (pooled > 0)
    vectors = model.embedding[buckets].mean(axis=1)
    d_vectors, d_filters = np.zeros_like(vectors), []
    docs = range(len(begin))
    for k, width in enumerate(WIDTHS):
        grad = np.zeros_like(model.filters[k])
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        best = np.stack([begin[d] + windows[k][begin[d] : ends[d]].argmax(axis=0) for d in docs])
        for place in range(width):
            at = stream[np.minimum(best + place, len(stream) - 1)]
            d, f = np.nonzero((at < len(buckets)) & (own != 0))
            word, columns, weight = at[d, f], place * FILTERS + f, own[d, f][:, None]
            np.add.at(grad.T, columns, weight * vectors[word])
            np.add.at(d_vectors, word, weight * model.filters[k][:, columns].T / 4)
        d_filters.append(grad)
    reached = np.flatnonzero(d_vectors.any(axis=1))
    rows, place = np.unique(buckets[reached], return_inverse=True)
    slope = np.zeros((len(rows), DIM), np.float32)
    np.add.at(slope, place.reshape(-1, 4), d_vectors[reached][:, None, :])
    return [rows, slope, *d_filters, back.sum(axis=0), pooled.T @ error, np.array([error.sum()], np.float32)]


def _thresholds(counts: list) -> np.ndarray:
    """For each language the logit between the classes with the best F1 on the rows left out, from
    rows (spoken, step, zeros, ones); for a language with fewer than LEAST_MARKS of either class there
    the one over all languages, and 0 if there are fewer in all."""
    spoken, step, zeros, ones = np.array([tuple(r) for r in counts], np.int64).reshape(-1, 4).T

    def best(rows: np.ndarray) -> float | None:
        if min(zeros[rows].sum(), ones[rows].sum()) < LEAST_MARKS:
            return None
        steps, place = np.unique(-step[rows], return_inverse=True)
        hits, all_ = (np.cumsum(np.bincount(place, n, len(steps))) for n in (ones[rows], ones[rows] + zeros[rows]))
        k = int((2 * hits / (all_ + hits[-1])).argmax())
        # Between the lower end of the last step taken and the upper end of the next one.
        return float(-steps[k] if k + 1 == len(steps) else (1 - steps[k] - steps[k + 1]) / 2) / FINE

    overall = best(np.ones(len(step), bool))
    found = [best(spoken == n) for n in range(len(FUNCTION_WORDS) + 1)]
    return np.array([(overall or 0.0) if t is None else t for t in found])


class _Words(dict):
    """Numbers of words, with their buckets, for one Python worker's table of responses."""

    def __init__(self):
        self.buckets: list[list[int]] = []
        self.names: list[str] = []

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self.buckets)
        self.buckets.append(features(word))
        self.names.append(word)
        return found


def in_fold(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of the id as text is divisible by FOLDS."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def marked_rows(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, zeros, ones): the labels of each document that is not held out, with how many are 0 and 1."""
    one = F.col(label).cast("int")
    return (labels.where(~in_fold(F.col("doc_id")) & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.sum(1 - one).alias("zeros"), F.sum(one).alias("ones")))


class _Scorer:
    """Logits and languages of texts, with a bounded table of words' responses kept between calls."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.table, self.votes = _Words(), None, None

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > MEMO_WORDS:
            self._forget()
        numbers, words = self.numbers, [words_of(t) for t in texts]
        docs = [np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)) for ws in words]
        have = 0 if self.table is None else self.table.shape[1] - 1
        if self.table is None or have < len(numbers.buckets):
            fresh = self.model.responses(np.array(numbers.buckets[have:], np.int64).reshape(-1, 4))
            said = ballots(numbers.names[have:])
            self.table = fresh if self.table is None else np.concatenate([self.table[:, :-1], fresh], axis=1)
            self.votes = said if self.votes is None else np.concatenate([self.votes[:-1], said])
        stream, begin = _stream(docs, self.table.shape[1] - 1)
        return self.model.logits(self.model.pooled(self.table, stream, begin)[0]), languages(self.votes, stream, begin)


SCORE_SCHEMA = "doc_id long, score double"


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, score) of every whole text and, with ``carry``, the whole input row as the struct ``row``; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    plain = id_text(docs, id_col, text_col)
    if carry:
        plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    names = ["doc_id", "score", *plain.columns[2:]]
    schema = SCORE_SCHEMA + (f", row {plain.schema['row'].dataType.simpleString()}" if carry else "")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = None if model is None else _Scorer(model)
        for batch in sub_batches(batches, 1, CHUNK):
            carried = batch.columns[2:]
            if scorer is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([0.0] * batch.num_rows), *carried], names)
                continue
            logits, spoken = scorer.score(texts_of(batch.column(1)))
            score = 1 / (1 + np.exp(-(logits - model.thresholds[spoken]).astype(np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), *carried], names)

    return plain.mapInArrow(rows, schema)


def classify(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, label: str = "toxic", carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (and ``row`` with ``carry``, as in score); trained on ``train_docs`` and ``labels``."""
    model = train(id_text(train_docs), labels, label)
    return score(docs, model, carry=carry).select("doc_id", F.coalesce(in_fold(F.col("doc_id")), F.lit(True)).alias("held_out"), "score",
                                                  (F.col("score") >= 0.5).cast("int").alias("predicted"), *(["row"] if carry else []))
