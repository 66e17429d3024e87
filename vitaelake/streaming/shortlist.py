"""The shortlist fold on a stream of actions, stored as a snapshot and what came after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitaelake.config import SHORTLIST_KEY
from vitaelake.operators.shortlist import fold_state, unpack
from vitaelake.sources import manifest

COMPACT_EVERY = 20
_SNAPSHOT, _BATCH = "snapshot=", "batch_id="


def start_shortlist(
    actions: DataFrame,
    out_path: str,
    checkpoint: str,
    key: Sequence[str] = SHORTLIST_KEY,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Fold a stream of actions and write the changed keys of every batch.

    The state holds one row per key. A batch overwrites its own folder, so a batch
    that is repeated after a failure leaves no second copy. After every
    ``compact_every`` batches the snapshot is renewed, so what readers scan is bounded
    by the keys and that many batches, not by the history.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/{_BATCH}{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_shortlist(batch.sparkSession, out_path, batch_id, key)

    return (
        fold_state(actions, key)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _numbers(spark: SparkSession, out_path: str, prefix: str) -> list[int]:
    found = manifest.names(spark, out_path)
    return sorted(int(name[len(prefix) :]) for name in found if name.startswith(prefix))


def _read(spark: SparkSession, out_path: str, upto: int | None = None) -> tuple[DataFrame | None, int]:
    """The snapshot and the batches after it, with ``batch_id``; and the snapshot's number."""
    batches = _numbers(spark, out_path, _BATCH)  # before the version, which may replace some
    _, content = manifest.latest(spark, out_path)
    snapshot = content.get("snapshot", -1)
    parts = [(n, f"{_BATCH}{n}") for n in batches if n > snapshot and (upto is None or n <= upto)]
    if snapshot >= 0:
        parts.insert(0, (snapshot, f"{_SNAPSHOT}{snapshot}"))
    if not parts:
        return None, snapshot
    schema = spark.read.parquet(f"{out_path}/{parts[0][1]}").schema
    rows = None
    for number, name in parts:
        part = spark.read.schema(schema).parquet(f"{out_path}/{name}")
        part = part.withColumn("batch_id", F.lit(number))
        rows = part if rows is None else rows.unionByName(part)
    return rows, snapshot


def _newest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of every key the row of its latest batch, found by an aggregate before the shuffle."""
    others = [c for c in rows.columns if c not in (*key, "batch_id")]
    newest = F.max_by(F.struct(*others), "batch_id").alias("row")
    return rows.groupBy(*key).agg(newest).select(*key, "row.*")


def compact_shortlist(
    spark: SparkSession, out_path: str, batch_id: int, key: Sequence[str] = SHORTLIST_KEY
) -> None:
    """Write the state after ``batch_id`` as the snapshot that readers start from.

    Repeated with the same or an older batch it changes nothing. What the snapshot
    replaces is deleted when the next one has been made, so a reader that started
    before finds its files.
    """
    rows, last = _read(spark, out_path, batch_id)
    if rows is None or last >= batch_id:
        return
    _newest(rows, key).write.mode("overwrite").parquet(f"{out_path}/{_SNAPSHOT}{batch_id}")

    def change(content: dict) -> dict | None:
        if content.get("snapshot", -1) >= batch_id:
            return None
        return {"snapshot": batch_id, "before": content.get("snapshot", -1)}

    content = manifest.update(spark, out_path, change)
    for prefix in (_BATCH, _SNAPSHOT):
        for number in _numbers(spark, out_path, prefix):
            if number < content["before"] or (prefix == _BATCH and number == content["before"]):
                manifest.delete(spark, f"{out_path}/{prefix}{number}")


def read_shortlist(
    spark: SparkSession, out_path: str, key: Sequence[str] = SHORTLIST_KEY
) -> DataFrame:
    """Current shortlist: of every key the row of its latest batch."""
    rows, _ = _read(spark, out_path)
    if rows is None:
        raise ValueError(f"no batch in {out_path}")
    return unpack(_newest(rows, key), key)
