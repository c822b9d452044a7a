"""A keyed table in files, kept by guarded upserts, and the sink of a stream that also writes dead letters."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Config
from ..operators.updates import merge
from ..schema import ATTRIBUTED


def retry(call: Callable[[], None], attempts: int = 5, first: float = 0.1, most: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> None:
    """Call until it succeeds, at most `attempts` times, waiting twice as long each time but at most `most` seconds."""
    wait = first
    for k in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if k == attempts:
                raise
            sleep(wait)
            wait = min(2 * wait, most)


class Table:
    """One row for each (page_view_id, user_id). Rows lie in `buckets` by a hash of the key; a batch rewrites only the
    buckets that it touches, into folders of its own number, and then writes its manifest, which makes them visible.
    A batch that runs again writes the same folders, so nothing is counted twice; without its manifest nothing is seen.

    A manifest says for every bucket which batch last wrote it, so only the newest is read; the last `keep` of them stay, with
    the folders that they name. inserts() has the rows as they were first written, each once: what counters, credit and
    latencies are taken from."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, keep: int = 10):
        self.spark, self.path, self.buckets, self.keep = spark, path, buckets, max(2, keep)

    def _folders(self, kind: str) -> list[int]:
        """The batches that have a folder of this kind, in order."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(top)] if fs.exists(top) else []
        return sorted(int(n.removeprefix("batch=")) for n in names if n.removeprefix("batch=").isdigit())

    def _complete(self) -> list[int]:
        """Batches whose manifest was written wholly."""
        jvm = self.spark.sparkContext._jvm
        done = lambda b: jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/batch={b}/_SUCCESS")
        fs = done(0).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [b for b in self._folders("manifests") if fs.exists(done(b))]

    def _manifest(self, batch: int) -> dict[int, int]:
        rows = self.spark.read.schema("bucket int, written long").parquet(f"{self.path}/manifests/batch={batch}")
        return {r["bucket"]: r["written"] for r in rows.collect()}  # at most `buckets` rows

    def _current(self, before: int | None = None) -> dict[int, int]:
        """The batch that last wrote each bucket."""
        done = [b for b in self._complete() if before is None or b < before]
        return self._manifest(done[-1]) if done else {}

    def read(self, current: dict[int, int] | None = None) -> DataFrame:
        paths = [f"{self.path}/rows/batch={b}/bucket={k}" for k, b in (self._current() if current is None else current).items()]
        columns = f"{ATTRIBUTED}, seq long"
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def inserts(self) -> DataFrame:
        """Each row as it was first written, with inserted_at."""
        paths = [f"{self.path}/inserts/batch={b}" for b in self._folders("inserts")]
        columns = f"{ATTRIBUTED}, inserted_at timestamp"
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def upsert(self, rows: DataFrame, batch: int) -> None:
        """rows: the changes of a batch; step, if there, tells their order."""
        key = ["page_view_id", "user_id"]
        bucket = F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")
        step = F.col("step") if "step" in rows.columns else F.lit(0)
        rows = rows.withColumn("_step", step).withColumn("seq", F.lit(batch).cast("long")).withColumn("bucket", bucket).persist()
        try:
            touched = [r[0] for r in rows.select("bucket").distinct().collect()]  # at most `buckets`
            current = self._current(before=batch)
            old = self.read({k: b for k, b in current.items() if k in touched}).withColumn("bucket", bucket)
            if touched:
                merged = merge(old.unionByName(rows.select(*old.columns)))
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/batch={batch}")
                rest = [c.split()[0] for c in ATTRIBUTED.split(", ") if c.split()[0] not in key]
                first = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), "_step").alias("r")).select(*key, "r.*")
                new = first.join(old.select(*key), key, "left_anti").withColumn("inserted_at", F.current_timestamp())
                new.write.mode("overwrite").parquet(f"{self.path}/inserts/batch={batch}")
            done = self.spark.createDataFrame([*(current | dict.fromkeys(touched, batch)).items()], "bucket int, written long")
            done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/batch={batch}")
        finally:
            rows.unpersist()
        self._compact()

    def _compact(self) -> None:
        """Old manifests go, then folders of rows that no other names."""
        done = self._complete()
        kept = done[-self.keep :]
        if len(done) <= self.keep:
            return
        used = {b for m in kept for b in self._manifest(m).values()}
        jvm = self.spark.sparkContext._jvm
        gone = [f"manifests/batch={b}" for b in done[: -self.keep]] + [f"rows/batch={b}" for b in self._folders("rows") if b < kept[0] and b not in used]
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def files(path: str) -> Callable[[DataFrame, int], None]:
    """Dead letters (key, value) of each batch in a folder of its own, which a repeated batch writes again."""
    return lambda letters, batch: letters.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def kafka(servers: str, topic: str = "dead_letter") -> Callable[[DataFrame, int], None]:
    """Dead letters to a topic, acknowledged by all replicas; a repeated batch sends them again with the same keys. Needs the
    Kafka connector."""
    sure = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true"}
    return lambda letters, batch: letters.write.format("kafka").options(**sure).save()


def writer(table: Table, dead_letters: str | Callable[[DataFrame, int], None], cfg: Config = Config()) -> Callable[[DataFrame, int], None]:
    """For foreachBatch on update.changes(): dead letters first (to files() in a folder, or what is given), then the guarded
    upsert, with retries."""
    topic = F.when(F.col("kind") == "c", cfg.click_topic).otherwise(cfg.view_topic)
    letter = F.to_json(F.struct(topic.alias("source_topic"), "partition", "offset", "reason", F.col("value").alias("payload")))
    send = files(dead_letters) if isinstance(dead_letters, str) else dead_letters

    def write(changes: DataFrame, batch: int) -> None:
        changes = changes.persist()
        try:
            dead = changes.where("what = 'dead_letter'").select(F.concat_ws(":", topic, "partition", "offset").alias("key"), letter.alias("value"))
            rows = changes.where("what = 'row'").select(*(c.split()[0] for c in ATTRIBUTED.split(", ")), "step")
            retry(lambda: send(dead, batch))
            retry(lambda: table.upsert(rows, batch))
        finally:
            changes.unpersist()

    return write
