"""Listing sightings as a stream: keyed upsert, delta of new records, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import corpus


class SnapshotStore:
    """Corpus snapshots in a shared folder, one per micro-batch; a batch that is run again writes the same place.

    Plain parquet has no merge, so each batch writes a new snapshot from the one before.  The newest complete
    snapshot is the corpus; ``_SUCCESS`` marks completeness.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):  # noqa: ANN202
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm

    def versions(self) -> list[int]:
        fs, folder, jvm = self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        whole = [n for n in names if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/corpus/_SUCCESS"))]
        return sorted(int(n[2:]) for n in whole)

    def current(self, before: int | None = None) -> DataFrame:
        done = [v for v in self.versions() if before is None or v < before]
        if not done:
            return self.spark.createDataFrame([], schemas.DOCS)
        return self.spark.read.schema(schemas.DOCS).parquet(f"{self.path}/v={done[-1]}/corpus")

    def write(self, version: int, df: DataFrame, part: str = "corpus") -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}/{part}")

    def prune(self, keep: int = 2) -> None:
        """Remove the corpus of all but the newest versions (two, so that the newest batch can be run again); deltas stay."""
        fs, _, jvm = self._fs()
        for version in self.versions()[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}/corpus"), True)

    def delta(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={version}/delta")


def usable() -> Column:
    """Whether a listing row has a title and a link."""
    linked = F.col("detail_page").isNotNull() | (F.size(F.coalesce("pdf_links", F.array().cast("array<string>"))) > 0)
    return (F.coalesce("title", F.lit("")) != "") & linked


def upsert_batch(store: SnapshotStore, rows: DataFrame, batch: int, now: str, as_of_year: int) -> None:
    """One micro-batch: new snapshot, delta of new records, and rows without title or link as dead letters."""
    rows = rows.withColumn("pos", F.coalesce(F.unix_micros(F.col("scanned_at").cast("timestamp")), F.lit(0)))
    good = rows.filter(usable())
    snapshot, fresh = corpus.upsert(store.current(before=batch), good, now, as_of_year)
    store.write(batch, rows.filter(~usable()).drop("pos"), "rejected")
    store.write(batch, fresh, "delta")
    store.write(batch, snapshot)
    store.prune()


def start(spark: SparkSession, source: str, store: SnapshotStore, checkpoint: str, now: str, as_of_year: int, backfill: bool = True, files_per_batch: int = 1000) -> StreamingQuery:
    """Read listing rows (parquet files of ``source``) and keep the corpus up to date.

    With ``backfill`` all that is there is taken in and the query ends; else it goes on as files arrive.
    """
    rows = spark.readStream.schema(schemas.LISTING).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: upsert_batch(store, df, n, now, as_of_year))
    return (writer.trigger(availableNow=True) if backfill else writer.trigger(processingTime="30 seconds")).start()


def first_sightings(rows: DataFrame, delay: str = "7 days") -> DataFrame:
    """A stream of each source id's first sighting (state is dropped ``delay`` after the newest scan time)."""
    return corpus.with_surrogate_ids(rows).withWatermark("scanned_at", delay).dropDuplicatesWithinWatermark(["liferay_id"])


def sightings_per_day(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Sightings and distinct ids per category and day of scanning, both exact; late rows count until the watermark passes.

    Counted per id first, so no state holds a day's ids together; a stream of it runs in append mode.
    """
    per_id = rows.withWatermark("scanned_at", delay).groupBy(F.window("scanned_at", "1 day"), "category", "liferay_id").agg(F.count("*").alias("n"))
    return per_id.groupBy("window", "category").agg(F.sum("n").alias("sightings"), F.count("liferay_id").alias("ids"))
