"""Handle uploaded files in micro-batches, each upload by itself.

A batch may hold any number of uploads of any sources. Its lines are archived
first and judged by upload; an upload that cannot be used is listed with the
reason and stops no other. The upload is part of the key of everything that
follows, so a result does not depend on which uploads share a batch. At the end
the batch is recorded, then its files are consumed; a batch that is repeated after
a failure replaces what it wrote, and one that was recorded is only consumed.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from thermoloom.operators.forecast import coefficients, stamp_model
from thermoloom.operators.quality import preprocess, rejected_readings
from thermoloom.plans.jobs import train_series
from thermoloom.schemas import CORRUPT, LANDED
from thermoloom.sources import files
from thermoloom.sources.tables import HEADER, archive_readings, write_model
from thermoloom.streaming.uploads import Uploads

#: Seconds between looks at the landing folder, and to wait at most.
POLL_SECONDS = 60
WAIT_SECONDS = 86_000

#: What became of each upload; trained ones have a row for each place.
RECORD = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("source", "upload", "place")),
        *(T.StructField(n, T.LongType()) for n in ("readings", "refused")),
        T.StructField("reason", T.StringType()),
    ]
)

Handler = Callable[[DataFrame, int], None]


def start(uploads: Uploads, spark: SparkSession, handle: Handler, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Handle what waits in the inbox, and stop."""
    stream = uploads.stream(spark, files_per_batch)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(
    uploads: Uploads,
    spark: SparkSession,
    handle: Handler,
    checkpoint: str,
    once: bool = False,
    poll: float = POLL_SECONDS,
    wait: float = WAIT_SECONDS,
    files_per_batch: int | None = None,
) -> None:
    """Claim and handle uploads; every ``poll`` seconds for ``wait`` seconds, or
    once. What an earlier run left in the inbox is handled first."""
    until = time.monotonic() + wait
    while True:
        uploads.claim(spark)
        if uploads.waiting(spark):
            start(uploads, spark, handle, checkpoint, files_per_batch).awaitTermination()
        if once or time.monotonic() + poll > until:
            return
        time.sleep(poll)


def _judged(lines: DataFrame, strict: bool) -> DataFrame:
    """One row per upload: its readings, how many a strict run would refuse, and
    why it cannot be used."""
    text = F.concat_ws(" ", "refused", F.lit("readings refused"))
    header = F.coalesce(F.col(HEADER.name), F.lit(False))
    data = lines.where(~header)
    refused = rejected_readings(data).groupBy("source", "upload").agg(F.count(F.lit(1)).alias("refused"))
    counted = lines.groupBy("source", "upload").agg(
        F.count_if(~header).alias("readings"), F.count_if(header | F.col(HEADER.name).isNull()).alias("headers")
    )
    reason = F.when(F.col("headers") == 0, "its header is another").when(F.col("readings") == 0, "no readings")
    if strict:
        reason = reason.when(F.col("refused") > 0, text)
    reason = reason.when(F.col("refused") == F.col("readings"), text)
    return counted.join(refused, ["source", "upload"], "left").na.fill(0, ["refused"]).withColumn("reason", reason)


@dataclass(frozen=True)
class UploadJob:
    """What the jobs share. ``records`` gets the fate of every upload and, if not
    ``strict``, the refused readings; a strict job uses no upload that has any."""

    archive: str
    records: str
    uploads: Uploads | None = None
    name: str = "upload"
    strict: bool = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = "-".join(filter(None, (self.name, query and query[:8], str(batch_id))))
        ledger = f"{self.records}/uploads/run_id={run}"
        if not files.exists(spark, f"{ledger}/_SUCCESS"):
            lines = self._archived(batch, run)
            judged = _written(_judged(lines, self.strict), f"{self.records}/judged/run_id={run}")
            good = judged.where("reason IS NULL").select("source", "upload")
            readings = lines.where(f"NOT coalesce({HEADER.name}, false)").drop(HEADER.name)
            rejected_readings(readings).write.mode("overwrite").parquet(f"{self.records}/rejects/run_id={run}")
            found = self.handle(readings.join(good, ["source", "upload"], "left_semi"), run)
            fate = judged.join(found, ["source", "upload"], "left") if found is not None else judged.withColumn("place", F.lit(None).cast("string"))
            why = F.coalesce("reason", "left_out") if found is not None else F.col("reason")
            fate.select("source", "upload", "place", "readings", "refused", why.alias("reason")).coalesce(1).write.mode("overwrite").parquet(ledger)
        if self.uploads:
            names = [r.upload for r in spark.read.schema(RECORD).parquet(ledger).select("upload").distinct().collect()]
            self.uploads.consume(spark, names)

    def _archived(self, batch: DataFrame, run: str) -> DataFrame:
        """The lines as archived: parsed once, and where a retry goes on from."""
        # rows that are no lines of files, such as a table read before: one upload without a header line
        kinds = {"upload": F.lit("batch"), HEADER.name: F.lit(None).cast("boolean"), CORRUPT.name: F.lit(None).cast("string")}
        batch = batch.withColumns({n: c for n, c in kinds.items() if n not in batch.columns})
        batch = batch.select(*[F.col(f"`{n}`") for n in (*LANDED.names, *kinds)])
        moment = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        return archive_readings(batch, self.archive, run, moment).drop("run_id", "ts")

    def handle(self, readings: DataFrame, run: str) -> DataFrame | None:
        """Work on the usable uploads; may return (source, upload, place, left_out)."""
        raise NotImplementedError


def _keyed(readings: DataFrame) -> DataFrame:
    """Readings of which the upload is part of the source."""
    return readings.withColumn("source", F.concat("upload", F.lit("/"), "source")).drop("upload")


def _apart(rows: DataFrame) -> DataFrame:
    """The upload of keyed rows as a column again. Its name has no slash."""
    return rows.withColumns({"upload": F.substring_index("source", "/", 1), "source": F.expr("substring(source, instr(source, '/') + 1)")})


@dataclass(frozen=True)
class FeatureJob(UploadJob):
    """Write the preprocessed readings of every upload to ``output``."""

    output: str = ""

    def handle(self, readings: DataFrame, run: str) -> None:
        _apart(preprocess(_keyed(readings), strict=False)).write.mode("overwrite").parquet(f"{self.output}/batch={run}")


@dataclass(frozen=True)
class TrainingJob(UploadJob):
    """Train on every upload alone and store the models of the newest of each source."""

    models: str = ""
    places: Iterable[str] = ("Out",)
    days: int | None = None
    ds: dt.date | None = None

    def handle(self, readings: DataFrame, run: str) -> DataFrame:
        clean = preprocess(_keyed(readings), strict=False)
        fitted = _written(_apart(train_series(clean, tuple(self.places), self.days)), f"{self.records}/fitted/run_id={run}")
        newest = fitted.where("reason IS NULL").groupBy("source", "place").agg(F.max("upload").alias("upload"))
        model = coefficients(fitted.join(newest, ["source", "place", "upload"], "left_semi"), "upload")
        write_model(stamp_model(model.withColumnRenamed("upload", "version"), self.ds or dt.date.today(), "version"), self.models)
        return fitted.select("source", "upload", "place", F.col("reason").alias("left_out"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
