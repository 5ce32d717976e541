"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Model: P(grade > k) = sigmoid(w . x - theta_k), theta ascending: one weight vector for all
thresholds.  x has a 1 for each bucket (a hash of a lower-cased word, or of its first 4 to 7
bytes; words are runs of ASCII letters and digits and of non-ASCII bytes) that a text holds.  Out come the expected
severity, the sum of P(grade > k), the most likely grade, and whether the text is rejected.

Fit: at most `sample` labelled rows of each class (the first by a hash of the id: a bounded
fit, stated here) are turned into buckets on executors.  Counts by bucket choose the telling
ones: those that graded rows hold more often than the largest of as many chance deviations
(signed root of the likelihood ratio against sqrt(2 ln of the number of buckets)).  The driver
gets each sampled row's telling buckets only, and fits w and theta by AdaGrad with a ridge;
clean and graded rows weigh alike in it.  Then all thresholds move by one number, so that
the mean of P(grade > 0) is the share of graded rows among all labelled ones: severities are
calibrated.  A text is rejected where its evidence, with clean and graded rows taken as
equally many, reaches `least`, and is not nothing: a text without telling buckets stays.
Where labels teach nothing, nothing is rejected and severities are 0.

Labels are grades from 0 up.  Where they only say toxic or not, the toxic rows get 1, 2 or 3
by thirds of how many telling buckets they hold: such grades order evidence, and aren't a
second opinion on it.  Scoring covers all rows in one pass, without a shuffle; the model,
8 MB at any size of input, is broadcast.

Of sampled rows of one class whose least shingle hash is the same (near copies, and all
wordless texts) one is learned from: so the fit sees at most `sample` rows of a class, often fewer.

Null, empty and wordless texts have no evidence: never rejected, and of the severity of a
text with no telling bucket.  Very long texts are worked through whole, in memory
proportional to the one text; a bucket counts once however often a text holds it.  Equal
evidence at the threshold rejects; ties of grades take the lower one.  Repeated rows score
alike, and repeated labels of an id count once, at the highest.  Without rows of both classes
the severity is 0 everywhere.  Null labels and ids are not learned from.  An empty table gives
no rows.  Further columns are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import BETWEEN
from .kernel import byte_view, prefix_hashes, release, shingle_sets, slices, word_spans
from .shared import stored, table

BITS, SAMPLE, GRADES, ROUNDS = 20, 4000, 4, 1000
#: Bytes of a word's beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6, 7)
RIDGE, RATE, LEAST_DOCS, LEAST = 1e-3, 0.3, 4, 0.5


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) pairs of data[offsets[0]:offsets[-1]], each once, in order."""
    starts, ends, doc = word_spans(data, offsets, BETWEEN)
    whole, *first = prefix_hashes(data[int(offsets[0]) : int(offsets[-1])], starts, ends, BEGINNINGS)
    size = ends - starts
    features = [(doc, whole), *((doc[longer], h[longer] ^ np.uint64(0x5851F42D4C957F2D)) for n, h in zip(BEGINNINGS, first) for longer in [size > n])]
    pairs = np.unique(np.concatenate([(d.astype(np.int64) << BITS) | (h >> np.uint64(64 - BITS)).astype(np.int64) for d, h in features]))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    even: float = 60.0  # the score at which evidence is even, with clean and graded rows equally many

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and k."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])

    def rejects(self, score: np.ndarray, least: float = LEAST) -> np.ndarray:
        return (score > 0) & (_sigmoid(score - self.even) >= least)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def ignorant() -> Model:
    """The model of labels that teach nothing: severity 0, and no text is rejected."""
    return Model(np.zeros(1 << BITS), np.full(GRADES - 1, 60.0))


def deviation(many: np.ndarray, graded_: np.ndarray, share: float) -> np.ndarray:
    """Signed root of the likelihood ratio of `graded_` of `many` against the share; about normal by chance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.nan_to_num(graded_ * np.log(graded_ / (many * share))) + np.nan_to_num((many - graded_) * np.log((many - graded_) / (many * (1 - share))))
    return np.sign(graded_ - many * share) * np.sqrt(2 * np.maximum(ratio, 0))


def thirds(toxic: np.ndarray, held: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """0 for rows that aren't toxic; for others 1.. by how many telling buckets they hold."""
    cuts = np.quantile(held[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    return np.where(toxic == 1, 1 + (held[:, None] > cuts[None, :]).sum(axis=1), 0)


def fit(grade: np.ndarray, rows: np.ndarray, words: np.ndarray, share: float | None = None, rounds: int = ROUNDS, ridge: float = RIDGE, rate: float = RATE) -> Model:
    """Weights and thresholds for graded rows; (rows, words) are the telling buckets that rows hold, by row; share: of graded rows among all (that of these rows if not given)."""
    n, top = len(grade), int(grade.max(initial=0))
    if not n or not top or grade.min() > 0 or not len(words):
        return ignorant()
    prior = (grade > 0).mean()
    known, words = np.unique(words, return_inverse=True)
    w, past = np.zeros(len(known)), np.full(len(known), 1e-8)
    weight = np.where(grade > 0, 0.5 / prior, 0.5 / (1 - prior))  # clean and graded rows count alike, whatever the sample's shares
    above = np.clip([np.average(grade > k, weights=weight) for k in range(top)], 1e-4, 1 - 1e-4)
    theta = -np.log(above / (1 - above))
    theta_past = np.full(top, 1e-8)
    lower, upper = np.maximum(grade - 1, 0), np.minimum(grade, top - 1)
    for _ in range(rounds):
        score = np.bincount(rows, weights=w[words], minlength=n)
        a = np.where(grade > 0, _sigmoid(score - theta[lower]), 1.0)  # P(above the grade below)
        b = np.where(grade < top, _sigmoid(score - theta[upper]), 0.0)  # P(above the grade)
        p = np.maximum(a - b, 1e-9)
        slope = weight * (a + b - 1) / n  # of the loss by the score
        g = np.bincount(words, weights=slope[rows], minlength=len(known)) + ridge * w
        past += g * g
        w = w - rate / np.sqrt(past) * g
        t = np.bincount(lower, weights=weight * np.where(grade > 0, a * (1 - a) / p, 0), minlength=top) - np.bincount(upper, weights=weight * np.where(grade < top, b * (1 - b) / p, 0), minlength=top)
        t /= n
        theta_past += t * t
        theta = np.maximum.accumulate(theta - rate * t / np.sqrt(theta_past) + 1e-3 * np.arange(top)) - 1e-3 * np.arange(top)
    score, share = np.bincount(rows, weights=w[words], minlength=n), prior if share is None else share
    real = weight * np.where(grade > 0, share, 1 - share)
    lo, hi = -40.0, 40.0
    for _ in range(60):  # the move of the thresholds at which the mean of P(grade > 0) is the share
        move = (lo + hi) / 2
        lo, hi = (move, hi) if np.average(_sigmoid(score - theta[0] - move), weights=real) > share else (lo, move)
    whole = np.zeros(1 << BITS)
    whole[known] = w
    return Model(whole, theta + move, float(theta[0]))


def _telling(sampled: DataFrame, share: float) -> np.ndarray:
    """Buckets of the sampled rows (label, words) that graded rows hold more often than chance explains."""

    def run(batches):
        many, bad = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for label, words in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.frombuffer(words, np.uint32)
                many[at] += 1
                bad[at] += label > 0
        at = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(many[at]), pa.array(bad[at])], ["bucket", "many", "bad"])

    counted = sampled.select("label", "words").mapInArrow(run, "bucket long, many long, bad long").groupBy("bucket").agg(F.sum("many").alias("many"), F.sum("bad").alias("bad")).where(F.col("many") >= LEAST_DOCS)
    counted = stored(counted, "toxicity-counts")
    tested = counted.count()
    more = counted.where(F.col("bad") > share * F.col("many")).toPandas().sort_values("bucket")  # a bucket a row: 2 ** BITS at most
    z = deviation(more["many"].to_numpy(float), more["bad"].to_numpy(float), share)
    return more["bucket"].to_numpy()[z >= np.sqrt(2 * np.log(max(2, tested)))]


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled rows of clean (label 0) and of graded ones (1 and up)."""
    known = labels.select(F.col("doc_id").cast("long").alias("of"), F.col(label_col).cast("int").alias("label")).where("of is not null and label >= 0").groupBy("of").agg(F.max("label").alias("label"))
    some = [known.where(k).orderBy(F.xxhash64("of"), "of").limit(sample) for k in ("label = 0", "label > 0")]
    few = F.broadcast(some[0].unionByName(some[1]))  # 2 * sample rows at most

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column(2))
            held, sketch = [], np.zeros(batch.num_rows, np.uint64)
            for lo, hi in slices(offsets):
                doc, words = buckets(data, offsets[lo : hi + 1])
                held += [x.astype(np.uint32).tobytes() for x in np.split(words, np.searchsorted(doc, np.arange(1, hi - lo)))]
                hashes, doc = shingle_sets(data, offsets[lo : hi + 1])
                first = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
                sketch[lo + doc[first]] = hashes[first]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary()), pa.array(sketch.view(np.int64))], ["doc_id", "label", "words", "sketch"])
        release()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(few, F.col("doc_id") == F.col("of")).select("doc_id", "label", "text")
    found = own.mapInArrow(run, "doc_id long, label int, words binary, sketch long")
    once = found.groupBy("label", "sketch").agg(F.min(F.struct("doc_id", "words")).alias("r"))  # near copies of one text aren't further evidence
    sampled = stored(once.select("r.doc_id", "label", "r.words"), "toxicity-sample")
    counts = sampled.agg(F.count("*").alias("rows"), F.count(F.when(F.col("label") > 0, 1)).alias("graded")).first()
    if not 0 < counts["graded"] < counts["rows"]:
        return ignorant()
    share = known.agg(F.avg((F.col("label") > 0).cast("double")).alias("share")).first()["share"]
    telling = _telling(sampled, counts["graded"] / counts["rows"])

    def only_telling(batches):
        for batch in batches:
            words = [np.frombuffer(x, np.uint32) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[np.isin(x, telling)].tobytes() for x in words], pa.binary())], ["doc_id", "label", "words"])

    got = sorted(sampled.mapInArrow(only_telling, sampled.schema).collect(), key=lambda r: (r["doc_id"], bytes(r["words"])))
    words = [np.frombuffer(r["words"], np.uint32).astype(np.int64) for r in got]
    size, label = np.array(list(map(len, words))), np.array([r["label"] for r in got], np.int64)
    grade = label if label.max() > 1 else thirds(label, size)
    return fit(grade, np.repeat(np.arange(len(got)), size), np.concatenate(words), share)


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """w . x of each text."""
    data, offsets = byte_view(texts)
    score = np.zeros(len(offsets) - 1)
    for lo, hi in slices(offsets):
        doc, words = buckets(data, offsets[lo : hi + 1])
        score[lo:hi] = np.bincount(doc, weights=model.weights[words], minlength=hi - lo)
    return score


def without_toxic(docs: DataFrame, model: Model, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that the model doesn't reject."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(~shared.value.rejects(scores(batch.column(at), shared.value), least)))
        release()

    return docs.mapInArrow(run, docs.schema)


def graded(docs: DataFrame, model: Model, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity: expected, grade: most likely, toxic) of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            score = scores(batch.column(1), model)
            above = model.above(score)
            each = -np.diff(np.concatenate([np.ones((len(score), 1)), above, np.zeros((len(score), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(model.rejects(score, least))], ["doc_id", "severity", "grade", "toxic"])
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return graded(docs, learn(docs, table(spark, sf_dir, "labels")))
