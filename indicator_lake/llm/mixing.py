"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

Every document of a source should be taken ``target / source size`` times. The whole part is taken for sure; of the
fractional parts two at a time are paired and mass (in words) moves between them at random until one is 0 or 1. That
keeps each document's expected number of copies and the source's words, up to one last document of each source.

Pairs form in blocks of a few hundred documents. Each block decides all of its documents but one, whose remaining
fraction goes on to the next level, so the tree has log(documents) / log(block) levels and no group ever holds more
than a block. Randomness is a hash of the document and a seed: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicator_lake.llm.tables import quoted, stored, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
BLOCK = 256  # documents of a block on average
_WHOLE = float(1 << 53)


def words_of(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share all words by weight. A target stops
    at ``most`` times its source; the excess goes to the others by weight: level * weight, with the level found from
    running sums over the sources in order of the level at which they fill up. Works on one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", (F.sum("source_size").over(every) - full) / open_weight)
    # with the first sources taken as full, the level of the rest rises as long as they are; its peak is the answer
    per = per.withColumn("level", F.max("level").over(every))
    return per.select("source", "source_size", F.least(F.col("level") * F.col("weight"), "most").alias("target"))


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / F.lit(_WHOLE)


_FOLD = """
aggregate(
  slice(items, 2, size(items)),
  named_struct('held', items[0], 'done', cast(array() AS array<struct<id: bigint, tag: bigint, up: int>>)),
  (acc, x) -> CASE
    WHEN acc.held.p <= 0 OR acc.held.p >= 1 THEN named_struct(
      'held', x,
      'done', array_append(acc.done, named_struct('id', acc.held.id, 'tag', acc.held.tag, 'up', int(acc.held.p >= 1))))
    WHEN x.p <= 0 OR x.p >= 1 THEN named_struct(
      'held', acc.held,
      'done', array_append(acc.done, named_struct('id', x.id, 'tag', x.tag, 'up', int(x.p >= 1))))
    ELSE transform(array(named_struct(
        'rise', least((1 - acc.held.p) * acc.held.size, x.p * x.size),
        'fall', least(acc.held.p * acc.held.size, (1 - x.p) * x.size))),
      m -> transform(array(IF(
          pmod(xxhash64(acc.held.id, acc.held.tag, x.id, x.tag, {seed}), 9007199254740992) / 9007199254740992D
            * (m.rise + m.fall) < m.fall, m.rise, -m.fall)),
        t -> CASE
          WHEN t > 0 AND m.rise = (1 - acc.held.p) * acc.held.size THEN named_struct(
            'held', named_struct('k', x.k, 'id', x.id, 'tag', x.tag, 'size', x.size, 'p', least(greatest(x.p - t / x.size, 0D), 1D)),
            'done', array_append(acc.done, named_struct('id', acc.held.id, 'tag', acc.held.tag, 'up', 1)))
          WHEN t > 0 THEN named_struct(
            'held', named_struct('k', acc.held.k, 'id', acc.held.id, 'tag', acc.held.tag, 'size', acc.held.size,
              'p', least(greatest(acc.held.p + t / acc.held.size, 0D), 1D)),
            'done', array_append(acc.done, named_struct('id', x.id, 'tag', x.tag, 'up', 0)))
          WHEN m.fall = acc.held.p * acc.held.size THEN named_struct(
            'held', named_struct('k', x.k, 'id', x.id, 'tag', x.tag, 'size', x.size, 'p', least(greatest(x.p - t / x.size, 0D), 1D)),
            'done', array_append(acc.done, named_struct('id', acc.held.id, 'tag', acc.held.tag, 'up', 0)))
          ELSE named_struct(
            'held', named_struct('k', acc.held.k, 'id', acc.held.id, 'tag', acc.held.tag, 'size', acc.held.size,
              'p', least(greatest(acc.held.p + t / acc.held.size, 0D), 1D)),
            'done', array_append(acc.done, named_struct('id', x.id, 'tag', x.tag, 'up', 1)))
        END)[0])[0]
  END)
"""


def pivotal(items: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """(grp, id, tag, up) for items (grp, id, tag, size, p): up is 0 or 1 with mean p.

    (grp, id, tag) names an item. The sum of size * up stays that of size * p within one item per group. Items of
    size 0 and items with p of 0 or 1 are decided at once.
    """
    settled = (F.col("size") <= 0) | (F.col("p") <= 0) | (F.col("p") >= 1)
    done = [items.where(settled).select("grp", "id", "tag", F.when(F.col("p") >= 1, 1).otherwise(0).alias("up"))]
    level = stored(items.where(~settled).select("grp", "id", "tag", F.col("size").cast("double"), "p"), "mix")
    depth = 0
    while True:
        most = level.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
        if most == 0:
            break
        blocks = 1 if most <= block else -(-most // block)
        place = F.pmod(F.xxhash64("id", "tag", F.lit(seed), F.lit(depth)), F.lit(blocks))
        # large documents first: the small ones after them settle them, so what stays over is small
        item = F.struct((-F.col("size")).alias("k"), "id", "tag", "size", "p")
        rows = level.groupBy("grp", place.alias("place")).agg(F.sort_array(F.collect_list(item)).alias("items"))
        folded = stored(rows.select("grp", F.expr(_FOLD.format(seed=f"{seed}L")).alias("r")), "mix")
        done.append(folded.select("grp", F.inline("r.done")))
        level = folded.select("grp", "r.held.id", "r.held.tag", "r.held.size", "r.held.p")
        if blocks == 1:
            last = (F.col("p") >= 1) | (_chance(F.col("id"), F.col("tag"), F.lit(seed + 2)) < F.col("p"))
            done.append(level.select("grp", "id", "tag", F.when(last, 1).otherwise(0).alias("up")))
            break
        depth += 1
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    return result


def copies(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, tag, source, rows, size, source_size, target, whole, more) for docs (doc_id, text, source).

    tag is a hash of source and text. Of the ``rows`` equal rows (same id, source and text) each is taken ``whole``
    times and ``more`` of them once again: that many of their fractions add up to whole rows at once, and what is left
    of them is one item of the rounding. A text without words has size 0 and is taken as often as the whole part
    says. A source whose documents are all empty has target 0 and no copies.
    """
    doc = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("source", "text").alias("tag"),
        words_of(F.col("text")).alias("size"),
    )
    doc = stored(doc.groupBy("doc_id", "source", "tag", "size").agg(F.count("*").alias("rows")), "mix")
    aim = targets(doc.select("source", (F.col("size") * F.col("rows")).alias("size")))
    planned = doc.join(aim, doc["source"].eqNullSafe(aim["source"])).drop(aim["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = planned.withColumn("whole", F.floor(rate)).withColumn("fraction", (rate - F.floor(rate)) * F.col("rows"))
    planned = planned.withColumn("sure", F.floor("fraction")).withColumn("p", F.col("fraction") - F.col("sure"))
    planned = stored(planned.drop("fraction"), "mix")
    items = planned.select(F.col("source").alias("grp"), F.col("doc_id").alias("id"), "tag", "size", "p")
    up = pivotal(items, seed).select(F.col("grp").alias("_grp"), F.col("id").alias("_id"), F.col("tag").alias("_tag"), "up")
    same = (
        planned["doc_id"].eqNullSafe(up["_id"]) & (planned["tag"] == up["_tag"]) & planned["source"].eqNullSafe(up["_grp"])
    )
    more = F.least(F.col("rows"), F.col("sure") + F.coalesce("up", F.lit(0)))
    return planned.join(up, same, "left").select(
        "doc_id", "tag", "source", "rows", "size", "source_size", "target",
        F.col("whole").cast("long").alias("whole"), more.cast("long").alias("more"),
    )


def _numbered(groups: DataFrame, rows: str, number: str, block: int = 4096) -> DataFrame:
    """A row for each of 1 to ``rows``, made in blocks so that no long array stands for a group of very many."""
    last = F.col(rows)
    blocks = groups.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{rows}` - 1) div {block}"))))
    first = F.col("_block") * block + 1
    return blocks.withColumn(number, F.explode(F.sequence(first, F.least(last, first + (block - 1))))).drop("_block")


def mixture(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source) for every row of docs."""
    every = _numbered(copies(docs, seed), "rows", "_row")
    every = every.withColumn("copies", F.col("whole") + F.when(F.col("_row") <= F.col("more"), 1).otherwise(0))
    return every.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )


def _place_in_group(rows: DataFrame, keys: list[str], place: str, part: str) -> DataFrame:
    """Number equal rows from 1: inside each task's share first, so that a group of very many rows stays spread."""
    inside = Window.partitionBy(*keys, part).orderBy(F.lit(1))
    own = stored(rows.withColumn(part, F.spark_partition_id()).withColumn(place, F.row_number().over(inside)), "mix")
    shares = own.groupBy(*keys, part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    names = {c: f"_of_{i}" for i, c in enumerate([*keys, part])}
    shares = shares.select(*[F.col(c).alias(n) for c, n in names.items()], "_before")
    same = [own[c].eqNullSafe(shares[n]) for c, n in names.items()]
    return own.join(shares, same).withColumn(place, F.col(place) + F.col("_before")).drop("_before", part, *names.values())


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    own = {c: unused(docs, f"mix_{c}") for c in ("id", "tag", "origin", "rows", "whole", "more", "place", "part", "copy")}
    renamed = {"doc_id": "id", "tag": "tag", "source": "origin", "rows": "rows", "whole": "whole", "more": "more"}
    found = copies(docs, seed).where("whole > 0 or more > 0").select(*[F.col(c).alias(own[n]) for c, n in renamed.items()])
    found = stored(found, "mix")
    # only rows that some, not all, of their equals are taken once more of need a number among them
    parted = (F.col(own["more"]) > 0) & (F.col(own["more"]) < F.col(own["rows"]))

    def with_docs(groups: DataFrame) -> DataFrame:
        same = (
            docs["doc_id"].cast("long").eqNullSafe(groups[own["id"]])
            & (F.xxhash64(docs["source"], docs["text"]) == groups[own["tag"]])
            & docs["source"].cast("string").eqNullSafe(groups[own["origin"]])
        )
        return docs.join(groups, same)

    every = with_docs(found.where(~parted)).withColumn(own["place"], F.lit(1).cast("bigint"))
    some = found.where(parted)
    if not some.isEmpty():  # else the texts need not be read again
        keys = [own["id"], own["tag"], own["origin"]]
        placed = _place_in_group(with_docs(some), keys, own["place"], own["part"])
        every = every.unionByName(placed.withColumn(own["place"], F.col(own["place"]).cast("bigint")))
    often = F.col(own["whole"]) + F.when(F.col(own["place"]) <= F.col(own["more"]), 1).otherwise(0)
    every = every.where(often > 0).withColumn(own["copy"], F.explode(F.sequence(F.lit(1).cast("bigint"), often)))
    return every.select(*map(quoted, docs.columns))
