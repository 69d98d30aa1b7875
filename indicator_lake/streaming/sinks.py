"""Message sources, the two-table sink of the event stream, and the compaction of its micro-batches."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from indicator_lake.sources import commits, tables
from indicator_lake.streaming.contract import Contract, accepted, rejected, validate

MESSAGE_SCHEMA = "value binary, message_id string"
QUERY_ID = "sql.streaming.queryId"  # the local property Spark sets for a stream's thread
VALID, REJECTED = "eventos_indicador", "eventos_rejeitados"


def file_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of Parquet files with ``value`` and ``message_id``."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def broker_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of a Kafka topic; needs Spark's Kafka connector on the class path."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.selectExpr("value", "concat_ws('-', topic, partition, offset) AS message_id")


def batch_writer(
    root: str, contract: Contract = Contract(), as_of: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: each message lands in exactly one of two tables.

    Every batch owns one folder per table and replaces it, so a replayed batch does not
    duplicate rows. The folder bears the query's id, which lives in the checkpoint: a stream
    with a new checkpoint counts its batches anew and must not replace those of the old one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "none"
        validated = validate(batch, contract, as_of).persist()
        try:
            for name, rows in ((VALID, accepted(validated)), (REJECTED, rejected(validated))):
                rows.write.mode("overwrite").parquet(f"{root}/{name}/query={query}/batch_id={batch_id}")
        finally:
            validated.unpersist()

    return write


def start(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    contract: Contract = Contract(),
    as_of: Column | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Route a message stream into the two event tables; ``drain`` stops when input is used up."""
    writer = messages.writeStream.foreachBatch(batch_writer(root, contract, as_of))
    writer = writer.option("checkpointLocation", checkpoint).queryName("indicator_events")
    return (writer.trigger(availableNow=True) if drain else writer).start()


def read_events(spark: SparkSession, root: str, name: str = VALID) -> DataFrame:
    """All rows of an event table: compacted folders and the micro-batches that no compaction covers."""
    path = f"{root}/{name}"
    state = commits.live(spark, path)
    if state is None:
        return spark.read.option("basePath", path).parquet(f"{path}/query=*").drop("query", "batch_id")
    open_batches = [_folder(q, i) for q, i in _batches(spark, path) if i > state.extra["covered"].get(q, -1)]
    kept = T.StructType.fromJson(json.loads(state.schema))
    return spark.read.schema(kept).parquet(*[f"{path}/{folder}" for folder in (*state.folders, *open_batches)])


def _folder(query: str, batch: int) -> str:
    return f"query={query}/batch_id={batch}"


def _batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(query id, batch id) of the micro-batch folders of an event table."""
    files = commits.Files(spark, path)
    queries = [n.removeprefix("query=") for n in files.names() if n.startswith("query=")]
    return sorted((q, int(n.removeprefix("batch_id="))) for q in queries for n in files.names(f"query={q}") if n.startswith("batch_id="))


def _done(spark: SparkSession, checkpoint: str) -> tuple[str, int]:
    """The query id of a checkpoint and the last micro-batch it recorded as finished."""
    files = commits.Files(spark, checkpoint)
    numbers = [int(n) for n in files.names("commits") if n.isdigit()]
    return json.loads(files.read("metadata"))["id"], max(numbers, default=-1)


def closed_batches(spark: SparkSession, root: str, name: str = VALID, checkpoint: str | None = None) -> dict[str, int]:
    """The last micro-batch of each query that is finished for good.

    Micro-batches run one after another, so all but the newest of a query are finished; with the query's
    checkpoint the newest counts too, if it is recorded there.
    """
    closed: dict[str, int] = {}
    newest: dict[str, int] = {}
    for query, batch in _batches(spark, f"{root}/{name}"):
        if query in newest:
            closed[query] = newest[query]
        newest[query] = batch
    if checkpoint:
        query, done = _done(spark, checkpoint)
        if newest.get(query, -1) <= done and query in newest:
            closed[query] = newest[query]
    return closed


def write_compacted(spark: SparkSession, root: str, closed: dict[str, int], name: str = VALID) -> tables.Staged | None:
    """Write the rows of the closed micro-batches that are not covered yet to a new folder; None if there are none."""
    path = f"{root}/{name}"
    state = commits.live(spark, path)
    covered = state.extra["covered"] if state else {}
    chosen = [(q, i) for q, i in _batches(spark, path) if covered.get(q, -1) < i <= closed.get(q, -1)]
    if not chosen:
        return None
    rows = spark.read.parquet(*[f"{path}/{_folder(q, i)}" for q, i in chosen])
    return tables.stage(rows, path, ["data_processamento"])


def compact(spark: SparkSession, root: str, name: str = VALID, checkpoint: str | None = None) -> int:
    """Rewrite closed micro-batches into large files and return how many rows moved.

    The new folder counts, and the folders it covers stop counting, with one commit; a compaction that ends before
    it changes nothing. The stream may run on. Two compactions at once do not both commit: the second one gives up.
    """
    path = f"{root}/{name}"
    before = commits.live(spark, path)
    covered = before.extra["covered"] if before else {}
    closed = closed_batches(spark, root, name, checkpoint)
    staged = write_compacted(spark, root, closed, name)
    if staged is None:
        return 0

    def change(last: commits.Commit) -> commits.Commit:
        if last.extra.get("covered", {}) != covered:
            raise commits.CommitConflict(f"{path}: another compaction committed meanwhile")
        folders = {**last.folders, staged.folder: {"rows": staged.rows, "covers": {**covered, **closed}}}
        return commits.Commit(last.number, folders, staged.schema, extra={"covered": {**covered, **closed}})

    commits.commit(spark, path, change)
    return staged.rows


def events_since(
    spark: SparkSession, root: str, consumed: dict[str, int], checkpoint: str | None = None, name: str = VALID
) -> tuple[DataFrame | None, dict[str, int]]:
    """Rows of finished micro-batches later than ``consumed`` (query id -> batch id), and how far they go.

    Where such a batch was compacted together with earlier ones, the rows of its whole folder come: some of them
    may have been seen before. None when there is nothing new.
    """
    path = f"{root}/{name}"
    state = commits.live(spark, path)
    covered = state.extra["covered"] if state else {}
    upto = {**consumed, **covered}
    for query, batch in closed_batches(spark, root, name, checkpoint).items():
        upto[query] = max(batch, upto.get(query, -1))
    folders = [f for f, entry in state.folders.items() if any(consumed.get(q, -1) < last for q, last in entry["covers"].items())] if state else []
    folders += [_folder(q, i) for q, i in _batches(spark, path) if max(covered.get(q, -1), consumed.get(q, -1)) < i <= upto.get(q, -1)]
    if not folders:
        return None, upto
    return spark.read.parquet(*[f"{path}/{folder}" for folder in folders]), upto


def remove_covered(spark: SparkSession, root: str, name: str = VALID, grace_seconds: float = commits.GRACE_SECONDS) -> list[str]:
    """Remove micro-batch folders that were compacted, and folders of failed compactions, after the grace time."""
    path = f"{root}/{name}"

    def superseded(state: commits.Commit) -> set[str]:
        return {_folder(q, i) for q, i in _batches(spark, path) if i <= state.extra["covered"].get(q, -1)}

    return commits.remove_old(spark, path, grace_seconds, superseded)
