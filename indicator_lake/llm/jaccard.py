"""N-gram Jaccard join of documents by a token-group matrix.

A document's set holds the hashes of its distinct runs of ``k`` lower-cased words. Steps:

1. Documents with the same set form a class (128-bit fingerprint of the set); only its smallest id goes on.
2. Similar classes are put into groups: those that share a band of minhash values with the smallest class of that
   band, when their exact Jaccard similarity with it reaches the threshold.
3. The matrix holds, for each group, the union of its members' prefix tokens (the rarest tokens of a set; two sets
   over the threshold always share one). A query whose prefix meets a group's union nowhere can't reach the needed
   overlap there; only the other groups are opened, and only at members that carry the token, fit in size, and have enough
   tokens from there on for the overlap that the threshold needs.
4. Opened pairs are compared exactly; components follow from all links.

The token order that defines "rare" comes from a count of hash buckets of fixed size over all documents. Any order
gives right results; this one keeps passages that many documents share out of the prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicator_lake.llm import vectors
from indicator_lake.llm.memory import tidy
from indicator_lake.llm.tables import components, stored, unused
from indicator_lake.llm.words import mix, sliced, windows

BUCKETS = 1 << 18  # of the token count; fixed, so its broadcast never grows
ID_BUCKETS = 1 << 20  # of the filter on document ids; fixed too
BANDS, ROWS = 12, 4
_U = np.uint64
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=_U)) | _U(1)
_FEATURES = "doc_id long, n long, f1 long, f2 long, bands array<long>, prefix array<long>"


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than k words count as one shingle."""
    for _, texts in sliced(column):
        words = texts.word_hashes(lower=True)
        for i in range(texts.n):
            own = words[texts.bounds[i] : texts.bounds[i + 1]]
            yield np.unique(windows(own, k) if len(own) >= k else windows(own, len(own)) if len(own) else own)


def needed(n: int | np.ndarray, percent: int):
    """The least overlap that a set of n needs with any set it links to."""
    return (percent * n + 99) // 100


def _count(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), k))
            if sets:
                found += np.bincount((np.concatenate(sets) & _U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        yield from vectors.parts(found)

    return run


def _features(k: int, percent: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for batch in batches:
            ids, sizes, f1, f2, bands, prefixes = batch.column(0), [], [], [], [], []
            for tokens in shingle_sets(batch.column(1), k):
                n = len(tokens)
                sizes.append(n)
                if not n:
                    f1.append(0), f2.append(0), bands.append(None), prefixes.append(None)
                    continue
                f1.append(int(mix(tokens).sum().view(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(mix(tokens + _U(0x632BE59BD9B4E019))).view(np.int64)))
                least = np.array([(tokens * f).min() for f in _FACTORS]).reshape(BANDS, ROWS)
                bands.append(windows_of_bands(least))
                weight = often[(tokens & _U(BUCKETS - 1)).astype(np.int64)]
                prefixes.append(tokens[np.lexsort((tokens, weight))[: n - needed(n, percent) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(f1, pa.int64()),
                    pa.array(f2, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "f1", "f2", "bands", "prefix"],
            )

    return run


def windows_of_bands(least: np.ndarray) -> np.ndarray:
    """One key for each band: a hash of its minima and its number."""
    key = np.arange(1, BANDS + 1, dtype=_U)
    for column in least.T:
        key = mix(key ^ column)
    return key.view(np.int64)


def _linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(shingle_sets(batch.column(2), k), shingle_sets(batch.column(3), k), strict=True):
                either = len(np.union1d(one, two))
                good.append(bool(either) and 100 * (len(one) + len(two) - either) >= percent * either)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _kept(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = wanted.value
        for batch in batches:
            found = batch.filter(pa.array(mask[batch.column(2).to_numpy()]))
            yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], ["doc_id", "text"])

    return run


def linked_pairs(texts: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts reach the threshold.

    Only texts that a fixed-size filter of wanted ids lets through are shuffled.
    """
    spark = texts.sparkSession
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS)).cast("int")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).select(bucket.alias("bucket")).distinct()
    mask = np.zeros(ID_BUCKETS, bool)
    mask[wanted.toArrow().column(0).to_numpy()] = True  # at most ID_BUCKETS rows
    few = texts.select("doc_id", "text", bucket.alias("bucket"))
    few = few.mapInArrow(tidy(_kept(spark.sparkContext.broadcast(mask))), "doc_id long, text string")
    one, two = few.toDF("a", "ta"), few.toDF("b", "tb")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(tidy(_linked(k, percent)), "a long, b long").distinct()


def similarity_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    Two documents link when 100 * shared >= percent * all of their shingles; the component is the smallest id
    reachable. Null, empty and wordless texts have no shingles and link with nothing. Rows that share a doc_id count
    as one document, linked wherever one of its texts is; a row without an id gets no component. Other columns of
    docs are ignored. Nothing is capped: the work beyond one pass over the texts follows the number of similar
    pairs in different groups.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = vectors.total(texts.select("text").mapInArrow(tidy(_count(k)), vectors.PART), BUCKETS)
    counts = spark.sparkContext.broadcast(counts.astype(np.int64))
    features = stored(texts.mapInArrow(tidy(_features(k, percent, counts)), _FEATURES), "features")

    named = features.where("n > 0 and doc_id is not null")
    classes = stored(
        named.groupBy("f1", "f2", "n").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("prefix").alias("prefix")
        ),
        "classes",
    )
    # similar classes: the smallest class of a band is the candidate for all others of the band
    banded = classes.select("rep", F.explode("bands").alias("band"))
    leads = banded.groupBy("band").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last")
    near = banded.join(leads, "band").where("rep > lead").groupBy("rep").agg(F.min("lead").alias("lead"))
    # a document with several texts belongs to several classes
    members = named.select("doc_id", "f1", "f2", "n").join(classes.select("f1", "f2", "n", "rep"), ["f1", "f2", "n"])
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").drop("b")
    joined = members.join(several, "doc_id").where("rep > a").select("a", F.col("rep").alias("b")).distinct()
    links = linked_pairs(texts, near.select(F.col("lead").alias("a"), F.col("rep").alias("b")), k, percent)
    groups = components(links.union(joined), "groups")

    # the matrix: token to group, for tokens that more than one group holds
    grouped = classes.join(groups, classes["rep"] == groups["node"], "left")
    tokens = grouped.select("rep", "n", F.coalesce("component", "rep").alias("grp"), F.posexplode("prefix").alias("pos", "token"))
    whole = Window.partitionBy("token")
    matrix = tokens.withColumn("low", F.min("grp").over(whole)).withColumn("high", F.max("grp").over(whole))
    matrix = stored(matrix.where("low < high").select("token", "grp", "rep", "n", "pos"), "matrix")
    queries, holders = matrix.toDF("token", "g", "a", "na", "pa"), matrix.toDF("token", "h", "b", "nb", "pb")
    # sets over the threshold share this much; at their first common token so much of both must still follow
    shared = f"ceil({percent} * (na + nb) / {100 + percent})"
    opened = (
        queries.join(holders, "token")
        .where("g < h")
        .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        .where(f"na - pa >= {shared} and nb - pb >= {shared}")
        .select("a", "b")
        .distinct()
    )
    more = linked_pairs(texts, stored(opened, "opened"), k, percent)
    stars = groups.where("node > component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = components(stars.union(more), "found")
    member = members.select("doc_id", "rep").distinct().join(found, F.col("rep") == F.col("node"), "left")
    member = member.groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    own = features.select("doc_id", F.col("n").alias("n_shingles")).join(member, "doc_id", "left")
    return own.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose id is the smallest of their component (rows without an id stay).

    Of rows that share such an id all stay. Columns and their order are those of docs.
    """
    found = similarity_components(docs, k, percent)
    own = unused(docs, "gone")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[own], "left_anti")
