"""Quality rules: countable page rules and a log-likelihood ratio of hashed n-grams.

The ratio compares a multinomial over hashed one- and two-word runs of trusted documents with that of the whole
corpus: ratio = sum over the document's n-grams of log p(trusted) - log p(corpus), divided by their number. The corpus
is counted over all documents, the trusted multinomial over at most ``MOST_TRUSTED`` labelled ones, drawn by a hash.
Texts are dealt into ``FOLDS`` by their words, and a text meets the trusted texts of the other folds only: so no score
rests on the document's own label, and labelled scores tell what unlabelled documents get.

The cut comes from the labels: of all ratios, the one that keeps the largest share of the trusted documents and
rejects the largest share of those labelled bad (the two shares added). A score is the ratio moved so that this cut
stands at ``THRESHOLD``, and a document passes at ``threshold`` or above. Every count enters as a share of another, so
a table repeated any number of times gets the same verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm import vectors
from indicator_lake.llm.memory import tidy
from indicator_lake.llm.tables import stored
from indicator_lake.llm.words import Texts, mix, sliced, windows

BUCKETS = 1 << 16
MOST_TRUSTED = 50_000  # labelled documents that the trusted multinomial is fitted on
THRESHOLD = -0.07  # nats per n-gram; also the cut itself where no labelled document is trusted
PRIOR_SHARE = 0.3  # of a bucket's mean count, added to each bucket, so that runs few documents have say little either way
FOLDS = 8
STEPS = 1024  # steps of a nat in which the cut is looked for
SCALE = 1 << 20  # gains are whole numbers of this fraction, so that sums do not depend on their order
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


def repeated_words(own: np.ndarray, k: int = WINDOW) -> int:
    """Words that lie in a run of k words which occurs twice or more."""
    runs = windows(own, k)
    if len(runs) < 2:
        return 0
    _, where, often = np.unique(runs, return_inverse=True, return_counts=True)
    if often.max() < 2:
        return 0
    edge = np.zeros(len(own) + 1, np.int64)
    starts = np.flatnonzero(often[where] > 1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + k, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(texts: Texts) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line of it."""
    data, offsets = texts.data, texts.offsets
    first = np.zeros(len(data) + 1, bool)
    first[1:][data == 0x0A] = True
    first[offsets[:-1]] = True
    starts = np.flatnonzero(first[: len(data)])
    ends = np.append(starts[1:], len(data))[: len(starts)]  # texts may all be empty
    ends = ends - (data[ends - 1] == 0x0A)
    seen = np.concatenate([[0], np.cumsum(texts.word)])
    worded = seen[ends] > seen[starts]
    starts, ends = starts[worded], ends[worded]
    keys = texts.hashes(starts, ends)
    cut = np.searchsorted(starts, offsets)
    return np.array([cut[i + 1] - cut[i] - len(np.unique(keys[cut[i] : cut[i + 1]])) for i in range(texts.n)], np.int64)


class Grams:
    """Buckets of the one- and two-word runs of some texts: two values a word, the second absent at a text's end."""

    def __init__(self, texts: Texts):
        words = texts.word_hashes()
        self.bounds = texts.bounds
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words, dtype=np.uint64)])[self.bounds]
        self.folds = (mix(np.diff(total)) % np.uint64(FOLDS)).astype(np.int64)  # equal texts share a fold
        self.one = (words & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.two = (windows(words, 2) & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.inside = np.ones(len(self.two), bool)
        cuts = self.bounds[1:-1]
        self.inside[cuts[(cuts > 0) & (cuts <= len(self.two))] - 1] = False

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each bucket occurs in the chosen texts."""
        word = np.repeat(chosen, np.diff(self.bounds))
        both = np.concatenate([self.one[word], self.two[self.inside & word[: len(self.two)]]])
        return np.bincount(both, minlength=BUCKETS)

    def means(self, gain: np.ndarray) -> np.ndarray:
        """Mean of whole-number gains (by fold, then bucket) over each text's n-grams; 0 without words. The same in any batch."""
        first = np.repeat(self.folds * BUCKETS, np.diff(self.bounds))
        each = gain[first + self.one]
        each[: len(self.two)] += np.where(self.inside, gain[first[: len(self.two)] + self.two], 0)
        total = np.concatenate([[0], np.cumsum(each)])[self.bounds]
        n = np.diff(self.bounds)
        return np.diff(total) / np.maximum(2 * n - 1, 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((1 + FOLDS) * BUCKETS)
    for batch in batches:
        trusted = batch.column(1).to_numpy(zero_copy_only=False)
        for row, texts in sliced(batch.column(0)):
            grams = Grams(texts)
            found[:BUCKETS] += grams.counts(np.ones(texts.n, bool))
            good = trusted[row : row + texts.n]
            for fold in np.unique(grams.folds[good]):
                found[(1 + fold) * BUCKETS : (2 + fold) * BUCKETS] += grams.counts(good & (grams.folds == fold))
    yield from vectors.parts(found)


def _judge(ratio, shift: float = 0.0, threshold: float = -np.inf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.round(ratio.value * SCALE).astype(np.int64)
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for _, texts in sliced(batch.column(1)):
                words, bounds = texts.word_hashes(), texts.bounds
                chars = texts.per_text(texts.word & ((texts.data & 0xC0) != 0x80))
                symbols, lines = texts.per_text(_SYMBOL[texts.data]), repeated_lines(texts)
                scores = Grams(texts).means(gain) / SCALE + shift
                again = np.array([repeated_words(words[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                n = np.diff(bounds)
                scores[n == 0] = 0
                failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)
                kept = ~failed & (scores >= threshold)
                for column, values in zip(columns, (n, chars, symbols, lines, again, failed, kept, scores), strict=True):
                    column.append(values)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            names = [f.split()[0] for f in _SCHEMA.split(", ")]
            arrays = [pa.array(np.concatenate(c) if c else [], k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    return run


def trusted_ids(labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """doc_id of documents whose every label says good quality and not toxic; of more than ``most`` a sample by hash."""
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = one.agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0").select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def gains(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log p(trusted of the other folds) - log p(corpus) for each fold and bucket; zeros when there is no trusted n-gram."""
    # at most MOST_TRUSTED ids: bounded, so texts need no shuffle to meet them
    flagged = _texts(docs).join(F.broadcast(trusted.withColumn("good", F.lit(True))), "doc_id", "left")
    flagged = flagged.select("text", F.coalesce("good", F.lit(False)).alias("good"))
    found = vectors.total(flagged.mapInArrow(tidy(_count), vectors.PART), (1 + FOLDS) * BUCKETS).reshape(1 + FOLDS, BUCKETS)
    corpus, target = found[0], found[1:].sum(axis=0) - found[1:]
    target[target.sum(axis=1) == 0] = found[1:].sum(axis=0)  # all trusted texts in one fold
    if not target.sum():
        return np.zeros(FOLDS * BUCKETS)
    share = target.sum(axis=1, keepdims=True) / corpus.sum()
    prior = PRIOR_SHARE * corpus.sum() / BUCKETS
    return (np.log((target + prior * share) / (corpus + prior)) - np.log(share)).ravel()


def best_cut(steps: list[tuple[int, int, int]]) -> float | None:
    """The cut by (step, trusted documents, bad documents) of labelled ratios, halfway between the two steps it parts.

    None when there are no trusted or no bad documents.
    """
    all_good, all_bad = sum(g for _, g, _ in steps), sum(b for _, _, b in steps)
    if not all_good or not all_bad:
        return None
    cut, best, before = None, -1, None
    value = all_good * all_bad  # both shares on one denominator, in whole numbers
    for step, good, bad in sorted(steps):
        if value > best:  # a cut below this step is better than all before
            best, cut = value, step if before is None else (before + 1 + step) / 2
        value += bad * all_good - good * all_bad
        before = step
    return cut / STEPS


def cut_shift(judged: DataFrame, labels: DataFrame) -> float:
    """What to add to the ratios (doc_id, base_failed, score) so that the cut of all labelled ones stands at THRESHOLD."""
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = one.agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).select(
        "doc_id", F.coalesce(F.expr("int(q = 1 and t = 0)"), F.lit(0)).alias("good"), F.coalesce(F.expr("int(q = 0)"), F.lit(0)).alias("bad")
    )
    ratios = judged.where("not base_failed").groupBy("doc_id", F.floor(F.col("score") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    both = ratios.join(marks.where("good + bad > 0"), "doc_id")
    # one row per step of a bounded range: gains lie within the logarithm of the buckets and of the trusted share
    rows = both.groupBy("step").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("bad")).alias("bad")).collect()
    cut = best_cut([(r["step"], r["good"], r["bad"]) for r in rows])
    trusted = [r["step"] for r in rows if r["good"]]
    if cut is None and trusted:  # no bad label: as far below the lowest trusted ratio as the trusted ones are apart
        cut = (2 * min(trusted) - max(trusted)) / STEPS
    return 0.0 if cut is None else THRESHOLD - cut


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs (doc_id, text): base counts, base verdict, score and the final verdict ``kept``.

    Null, empty and wordless texts have zero counts and fail the base rules. Without trusted documents every score
    is 0. Repeated rows are judged alike; other columns of docs and labels are ignored.
    """
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(docs, trusted_ids(labels)))
    judged = stored(_texts(docs).mapInArrow(tidy(_judge(gain)), _SCHEMA), "judged")
    score = F.when(F.col("n_words") > 0, F.col("score") + F.lit(cut_shift(judged, labels))).otherwise(0.0)
    judged = judged.withColumn("score", score)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def passing(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the rules keep, with their columns as they were.

    The verdict is taken in the same pass as the row, so no join is needed.
    """
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(docs, trusted_ids(labels)))
    shift = cut_shift(_texts(docs).mapInArrow(tidy(_judge(gain)), _SCHEMA), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(gain, shift, threshold)
        for batch in batches:
            ids = pa.array(range(batch.num_rows), pa.int64())
            text = batch.column(batch.schema.get_field_index("text"))
            verdict = next(judge(iter([pa.RecordBatch.from_arrays([ids, text], ["doc_id", "text"])])))
            yield batch.filter(verdict.column(7))

    return docs.mapInArrow(tidy(run), docs.schema)
