"""Quality classifier by co-training of two views.

One view sees the text (hashed words), the other the metadata (language, source, size). Each is a
naive Bayes model over hashed features, started on the labelled documents. In every round each view scores all
documents, and the share of the unlabelled ones that it is most sure of, of either class, become examples for the other
view; the share grows from round to round, and an example counts as much as its calibrated probability lies beyond the
share of its class, so a view that knows little moves the other one little. At the end each view is calibrated on labelled documents and the calibrated
views are combined to score all documents.

Models, score histograms and counts are vectors of fixed size, summed over all tasks. The labelled documents are a
bounded sample, so texts meet their labels without a shuffle; every round goes twice over all documents where they lie,
for the histogram that places the cuts and for the examples beyond them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm import vectors
from indicator_lake.llm.tables import stored
from indicator_lake.llm.words import mix, sliced

TEXT_BUCKETS = 1 << 17
META_BUCKETS = 1 << 13
ROUNDS = 2
MOST_LABELLED = 50_000  # labelled documents, drawn by a hash, that the views start from and are calibrated on
SURE = 0.97  # calibrated probability from which on a view hands every document over
HANDED = 0.01  # share of the unlabelled documents that a view hands over in the first round anyhow, twice as many in the second
BINS = 2048  # of the score histograms that the calibration uses
SPAN = 32.0  # scores beyond it count into the outer bins
TEXT_PRIOR, META_PRIOR = 20.0, 20.0
_U = np.uint64


@dataclass
class View:
    """Log odds of each bucket for good against bad, the cuts for sure examples and the calibration line.

    A cut is a bin of scores and the part of the documents in this very bin that go beyond it, told by their ids.
    """

    odds: np.ndarray
    low: tuple[int, float] = (-1, 0.0)
    high: tuple[int, float] = (BINS, 0.0)
    slope: float = 1.0
    offset: float = 0.0
    base: float = 0.5

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -30, 30)))

    def weights(self) -> np.ndarray:
        """How much an example of each bin counts: how far from the base share towards its class its probability lies.

        Parts of 1,024, so that sums are the same in any order.
        """
        p = self.probability((_edges()[:-1] + _edges()[1:]) / 2)
        return np.ceil(np.where(p > self.base, (p - self.base) / (1 - self.base), (self.base - p) / self.base) * 1024) / 1024

    def sure_of(self, place: int, draw: float) -> int | None:
        """1, 0 or, between the cuts, None for a document with a score in bin ``place``; ``draw`` decides in a cut's bin."""
        (low, low_part), (high, high_part) = self.low, self.high
        if place > high or (place == high and draw < high_part):
            return 1
        return 0 if place < low or (place == low and draw >= 1 - low_part) else None


def text_features(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each text's words."""
    for _, texts in sliced(column):
        words = (texts.word_hashes() & _U(TEXT_BUCKETS - 1)).astype(np.int64)
        for i in range(texts.n):
            yield np.unique(words[texts.bounds[i] : texts.bounds[i + 1]])


def meta_features(languages: list, sources: list, sizes: list) -> Iterator[np.ndarray]:
    """Buckets of the language, the source, the size class and language with size class."""
    for language, source, size in zip(languages, sources, sizes, strict=True):
        step = -1 if size is None else int(2 * math.log2(max(size, 0) + 1))
        keys = (("l", language), ("s", source), ("n", step), ("b", language, step))
        hashes = np.array([int.from_bytes(_digest(repr(k)), "little") for k in keys], _U)
        yield np.unique((mix(hashes) & _U(META_BUCKETS - 1)).astype(np.int64))


def _digest(text: str) -> bytes:
    import hashlib

    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()


def _draws(ids: pa.Array) -> list[float]:
    """A number in [0, 1) for each id, the same on every pass; 0 for a null id."""
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).astype(_U)
    return ((mix(known) >> _U(11)).astype(np.float64) / (1 << 53)).tolist()


def bin_of(score: np.ndarray) -> np.ndarray:
    return np.clip(((score + SPAN) / (2 * SPAN) * BINS).astype(np.int64), 0, BINS - 1)


def score_of(features: np.ndarray, odds: np.ndarray) -> float:
    """Log odds over the square root of their number, so that their noise does not grow with the text; 0 without any.

    Whole numbers are added, so that the score is the same in any batch.
    """
    total = np.round(odds[features] * (1 << 20)).astype(np.int64).sum()
    return float(total) / (1 << 20) / math.sqrt(max(len(features), 1))


def _pass(views, begin: int):
    """Over (doc_id, text, lang, source, n_chars, good): example counts for the next models and score histograms.

    good is 1, 0 or null (unlabelled). A view's examples are the labelled documents and those unlabelled ones that
    the *other* view is sure of. The vector holds, for text then metadata: bad counts, good counts; the numbers of
    examples; and histograms of the scores of bad, good and unlabelled documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_view, meta_view = views.value if views else (None, None)
        weights = [view.weights() for view in views.value] if views else None
        total = np.zeros(begin)
        for batch in batches:
            columns, draws = [c.to_pylist() for c in batch.columns[2:]], _draws(batch.column(0))
            pairs = zip(text_features(batch.column(1)), meta_features(*columns[:3]), columns[3], draws, strict=True)
            for own_text, own_meta, good, draw in pairs:
                classes, counts = [good, good], [1.0, 1.0]  # for the text model, for the metadata model
                if text_view is not None:
                    scores = score_of(own_text, text_view.odds), score_of(own_meta, meta_view.odds)
                    kind = 2 if good is None else int(good)
                    places = [int(bin_of(np.array(score))) for score in scores]
                    for view, place in enumerate(places):
                        total[_HISTOGRAM + (view * 3 + kind) * BINS + place] += 1
                    if good is None:
                        classes = [meta_view.sure_of(places[1], draw), text_view.sure_of(places[0], draw)]
                        counts = [weights[1][places[1]], weights[0][places[0]]]
                for view, (features, start, size) in enumerate(((own_text, 0, TEXT_BUCKETS), (own_meta, 2 * TEXT_BUCKETS, META_BUCKETS))):
                    if classes[view] is not None:
                        total[start + int(classes[view]) * size + features] += counts[view]
                        total[_EXAMPLES + 2 * view + int(classes[view])] += 1
        yield from vectors.parts(total)

    return run


_EXAMPLES = 2 * TEXT_BUCKETS + 2 * META_BUCKETS
_HISTOGRAM = _EXAMPLES + 4
_SIZE = -(-(_HISTOGRAM + 6 * BINS) // vectors.WIDTH) * vectors.WIDTH


def _model(bad: np.ndarray, good: np.ndarray, prior: float) -> np.ndarray:
    """Log odds of meeting a bucket in a good against a bad document, shrunk for buckets that few examples have."""
    n_bad, n_good = bad.sum(), good.sum()
    if not n_bad or not n_good:
        return np.zeros(len(bad))
    share = n_good / (n_good + n_bad)
    return np.log((good + prior * share) / (bad + prior * (1 - share))) - math.log(share / (1 - share))


def _models(total: np.ndarray) -> tuple[View, View]:
    cut = np.cumsum([TEXT_BUCKETS, TEXT_BUCKETS, META_BUCKETS])
    bad_text, good_text, bad_meta, good_meta = np.split(total[:_EXAMPLES], cut)
    return View(_model(bad_text, good_text, TEXT_PRIOR)), View(_model(bad_meta, good_meta, META_PRIOR))


def _histograms(total: np.ndarray) -> np.ndarray:
    return total[_HISTOGRAM : _HISTOGRAM + 6 * BINS].reshape(2, 3, BINS)


def _edges() -> np.ndarray:
    return (np.arange(BINS + 1) / BINS * 2 - 1) * SPAN


def _calibrate(view: View, histogram: np.ndarray) -> None:
    """A logistic line through the labelled score histogram, by Newton steps on the bins."""
    bad, good, _ = histogram
    n, x = bad + good, (_edges()[:-1] + _edges()[1:]) / 2
    slope, offset = 0.0, 0.0
    if not bad.sum() or not good.sum():
        view.slope, view.offset = 0.0, 0.0
        return
    view.base = good.sum() / n.sum()
    target = (good * (good.sum() + 1) / (good.sum() + 2) + bad / (bad.sum() + 2)) / np.maximum(n, 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = n * p * (1 - p)
        g = np.array([(n * (target - p) * x).sum() - 1e-3 * slope, (n * (target - p)).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        size = float(np.abs(step).max())
        step *= min(1.0, 2.0 / size) if size else 1.0
        slope, offset = slope + step[0], offset + step[1]
        if size < 1e-9:
            break
    view.slope, view.offset = float(slope), float(offset)


def _cuts(view: View, histogram: np.ndarray, share: float, sure: float = SURE) -> None:
    """Cuts beyond which the view is ``sure``, or else those ``share`` of the unlabelled documents of which it is surest.

    The share is split between the classes as the labelled documents are. A tail in which the labelled documents are of its class no more often than everywhere is not handed over, nor is
    anything of a view whose scores say nothing.
    """
    bad, good, open_ = histogram
    view.low, view.high = View.low, View.high
    if view.slope <= 0 or not open_.sum():
        return
    base = view.base
    low, low_part = _tail(open_, share * (1 - base) * open_.sum())
    top, high_part = _tail(open_[::-1], share * base * open_.sum())
    high = BINS - 1 - top
    if bad[: low + 1].sum() * base > good[: low + 1].sum() * (1 - base):
        view.low = low, low_part
    if good[high:].sum() * (1 - base) > bad[high:].sum() * base:
        view.high = high, high_part
    p = view.probability((_edges()[:-1] + _edges()[1:]) / 2)
    view.low = max(view.low, (int((p <= 1 - sure).sum()) - 1, 1.0))
    view.high = min(view.high, (BINS - int((p >= sure).sum()), 1.0), key=lambda cut: (cut[0], -cut[1]))


def _tail(counts: np.ndarray, wanted: float) -> tuple[int, float]:
    """The bin in which the first ``wanted`` documents end, and the part of it that they take."""
    reached = np.cumsum(counts)
    place = int(np.searchsorted(reached, wanted))
    return place, float((wanted - (reached[place] - counts[place])) / max(counts[place], 1))


def _finish(views, base: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_view, meta_view = views.value
        for batch in batches:
            text = np.array([score_of(f, text_view.odds) for f in text_features(batch.column(1))])
            meta = np.array([score_of(f, meta_view.odds) for f in meta_features(*(c.to_pylist() for c in batch.columns[2:5]))])
            one, two = text_view.probability(text), meta_view.probability(meta)
            logit = np.log(one / (1 - one)) + np.log(two / (1 - two)) - math.log(base / (1 - base))
            both = 1 / (1 + np.exp(-logit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(one), pa.array(two), pa.array(both), pa.array(both >= threshold)],
                ["doc_id", "text_score", "meta_score", "score", "kept"],
            )

    return run


@dataclass(frozen=True)
class Trained:
    """The calibrated views, the share of good labelled documents, and the examples each view learnt from.

    ``examples`` has a row a round, first the start: (bad, good) of the text view, (bad, good) of the metadata view.
    """

    views: tuple[View, View]
    base: float
    examples: list[tuple[int, int, int, int]]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
        F.col("source").cast("string"), F.col("n_chars").cast("long"),
    )


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, handed: float = HANDED) -> Trained:
    """Train the two views on each other's surest documents; see ``quality_scores`` for the tables."""
    if not 0 <= handed * rounds <= 0.5:
        raise ValueError("a view can hand over half of the unlabelled documents at most")
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.min("quality") == 1).cast("int").alias("good")
    )
    marks = marks.where("good is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    every = _rows(docs)
    labelled = stored(every.join(F.broadcast(marks), "doc_id"), "labelled")
    unmarked = F.lit(None).cast("int").alias("good")

    def add(rows: DataFrame, views: tuple[View, View] | None) -> np.ndarray:
        sent = spark.sparkContext.broadcast(views) if views else None
        return vectors.total(rows.mapInArrow(_pass(sent, _SIZE), vectors.PART), _SIZE)

    def unlabelled(views: tuple[View, View]) -> np.ndarray:
        # sums are additive: what all documents give less what the labelled ones give is the unlabelled ones' part
        return add(every.select("*", unmarked), views) - add(labelled.drop("good").select("*", unmarked), views)

    truth = add(labelled, None)
    views, examples = _models(truth), [truth]
    for turn in range(rounds + 1):
        seen = _histograms(add(labelled, views))
        for view, histogram in zip(views, seen, strict=True):
            _calibrate(view, histogram)
        if turn < rounds and truth[_EXAMPLES : _EXAMPLES + 2].all():
            for view, histogram in zip(views, seen + _histograms(unlabelled(views)), strict=True):
                _cuts(view, histogram, handed * (turn + 1))
            examples.append(truth + unlabelled(views))
            views = _models(examples[-1])
    good, bad = seen[0][1].sum(), seen[0][0].sum()
    base = float(np.clip(good / max(1, good + bad), 0.01, 0.99)) if good and bad else 0.5
    return Trained(views, base, [tuple(int(n) for n in total[_EXAMPLES : _EXAMPLES + 4]) for total in examples])


def quality_scores(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, handed: float = HANDED, threshold: float = 0.5) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) for every row of docs (doc_id, text, lang, source, n_chars).

    A document is good when all its labels say quality 1, bad when one says 0, unlabelled without any. Scores are
    calibrated probabilities of being good; the combined one adds the views' evidence. Null and empty texts have no
    text features and get the view's base score; missing metadata is a value of its own. Without labels of both
    classes every score is 0.5. Repeated rows score alike; other columns are ignored.
    """
    trained = co_train(docs, labels, rounds, handed)
    schema = "doc_id long, text_score double, meta_score double, score double, kept boolean"
    sent = docs.sparkSession.sparkContext.broadcast(trained.views)
    return _rows(docs).mapInArrow(_finish(sent, trained.base, threshold), schema)
