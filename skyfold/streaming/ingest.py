"""Ingest each newly landed bronze file exactly once.

A file stream over the landing folder feeds ``foreachBatch`` with the paths that have
arrived, one row a file, whatever the file holds.  Files are flattened when they arrive, each once; a batch is loaded (silver, key check, staging,
publish) when all files landed for it have arrived.

Between its first and its last file a batch is *pending*: a ledger (a log of numbered
records beside the landing) names the folders that hold its flattened rows so far and the
files they came from; of a loaded batch it holds the names of its files.  A
micro-batch that is run again finds its files in the ledger and adds nothing; a file that
comes to a loaded batch is added to the rows silver has of it.  A batch that is landed anew while it is pending
starts again: rows of files that are gone don't count.  A batch that arrives again with
no rows is emptied in every layer.  With ``availableNow`` every run processes what has
arrived since the last one and stops; the checkpoint makes a second run add nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyfold.plans.jobs import FLOWS, Layout, load_silver
from skyfold.sinks.commitlog import SequenceLog
from skyfold.sinks.tables import drop_folder, landed_batches, names_in
from skyfold.sources import readers as RD


def _start() -> dict:
    return {"pending": {}, "loaded": {}}


def _fold(state: dict, number: int, record: dict) -> dict:
    for b, part in record.get("pending", {}).items():
        state["pending"].setdefault(b, []).append(part)
    for b, names in record.get("loaded", {}).items():
        state["pending"].pop(b, None)
        state["loaded"][b] = names
    for b in record.get("forget", []):
        state["loaded"].pop(b, None)
    return state


def ledger(spark: SparkSession, layout: Layout, dataset: str) -> SequenceLog:
    """Pending batches ``{batch: [{"folder": flattened rows, "files": [names]}, ...]}`` and
    loaded ones ``{batch: [names]}`` (those still in the landing)."""
    return SequenceLog(spark, f"{layout.root}/intake/{dataset}", _fold, _start)


def landed_files(spark: SparkSession, layout: Layout, dataset: str, batch_id: str) -> set[str]:
    """Names of the objects of a batch in the landing folder (objects of no length hold
    nothing and never arrive: Spark doesn't read them)."""
    found = names_in(spark, f"{layout.bronze(dataset)}/batch_id={batch_id}", not_empty=True)
    return {n for n in found if n[0] not in "._"}


def load_arrivals(spark: SparkSession, layout: Layout, dataset: str, arrived: dict[str, list[str]],
                  as_of: dt.datetime, on_key_violation: str = "fail", publish: str | None = "replace_batch",
                  multi_line: bool = False) -> list[str]:
    """Take in files (``{batch: [paths]}``) and load the batches they complete; returns
    these batches."""
    flow, log = FLOWS[dataset], ledger(spark, layout, dataset)
    state = log.read()[1]
    pending = state["pending"]
    silver = T.StructType([*flow["silver"].fields, T.StructField("batch_id", T.StringType())])
    new: dict[str, list[str]] = {}  # files of each batch that are flattened now
    parts: dict[str, list[dict]] = {}
    complete: dict[str, list[str]] = {}
    more: list[str] = []  # loaded batches that get more files
    for b, paths in arrived.items():
        landed, before = landed_files(spark, layout, dataset, b), set(state["loaded"].get(b, []))
        by_name = {p.rsplit("/", 1)[1]: p for p in paths}
        by_name = {n: p for n, p in by_name.items() if n in landed}
        if not by_name or landed == before:
            continue  # landed anew since (its files arrive by themselves), or loaded before
        # a part with a file that is gone is of an earlier landing
        parts[b] = [p for p in pending.get(b, []) if set(p["files"]) <= landed]
        held = {f for p in parts[b] for f in p["files"]}
        if before and before <= landed:
            more.append(b)
            held |= before
        elif before:  # of an earlier landing, but a file is still there
            by_name |= {n: f"{layout.bronze(dataset)}/batch_id={b}/{n}" for n in before & landed}
        new[b] = sorted(by_name[n] for n in by_name.keys() - held)
        if landed <= held | by_name.keys():
            complete[b] = sorted(landed)

    def rows_folder() -> str:
        return f"{layout.root}/intake/_rows/{uuid.uuid4().hex}"

    def flattened(batches: list[str]) -> DataFrame | None:
        files = [f for b in batches for f in new.get(b, [])]
        if not files:
            return None
        docs = RD.read_bronze(spark, files, flow["schema"], multi_line, base=layout.bronze(dataset))
        return flow["flatten"](docs).select(*silver.fieldNames())

    waiting = [b for b in sorted(new) if b not in complete and new[b]]
    if waiting:
        folder = rows_folder()
        flattened(waiting).write.parquet(folder)
        record = {b: {"folder": folder, "files": [f.rsplit("/", 1)[1] for f in new[b]]} for b in waiting}
        log.append(lambda state: {"pending": record})
    if complete:
        frames, copies = [flattened(list(complete))], []
        if again := [b for b in more if b in complete]:  # silver is about to be written
            copies.append(rows_folder())
            RD.read_silver(spark, layout.silver(dataset), flow["silver"]).where(
                F.col("batch_id").isin(again)).write.parquet(copies[0])
            frames.append(spark.read.schema(silver).parquet(copies[0]))
        for folder in sorted({p["folder"] for b in complete for p in parts[b]}):
            of = [b for b in complete if any(p["folder"] == folder for p in parts[b])]
            frames.append(spark.read.schema(silver).parquet(folder).where(F.col("batch_id").isin(of)))
        rows = reduce(DataFrame.unionByName, [f for f in frames if f is not None] or [
            spark.createDataFrame([], silver)])
        load_silver(spark, layout, dataset, rows, sorted(complete), as_of, on_key_violation, publish)
        there = set(landed_batches(spark, layout.bronze(dataset)))
        log.append(lambda now: {"loaded": complete, "forget": sorted(now["loaded"].keys() - there)})
        left = {p["folder"] for ps in log.read()[1]["pending"].values() for p in ps}
        for folder in [*copies, *{p["folder"] for b in complete for p in pending.get(b, [])} - left]:
            drop_folder(spark, folder)
    return sorted(complete)


def start_ingest(spark: SparkSession, layout: Layout, dataset: str, as_of: dt.datetime,
                 checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None, on_key_violation: str = "fail",
                 publish: str | None = "replace_batch", multi_line: bool = False) -> StreamingQuery:
    """Start the intake stream.

    The stream itself carries batch ids and paths only.  With ``max_files_per_trigger`` a
    backlog is worked off in several micro-batches; each file is flattened in its own.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # the content is not read
    arrivals = reader.load(layout.bronze(dataset)).select(
        F.regexp_extract("path", "/batch_id=([^/]+)/[^/]*$", 1).alias("batch_id"), "path").where("batch_id <> ''")

    def load(micro: DataFrame, epoch_id: int) -> None:
        # one row per arrived file reaches the driver, as the listing of the landing does
        arrived: dict[str, list[str]] = {}
        for r in micro.distinct().collect():
            arrived.setdefault(r.batch_id, []).append(r.path)
        if arrived:
            load_arrivals(spark, layout, dataset, arrived, as_of, on_key_violation, publish, multi_line)

    writer = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def ingest_available(spark: SparkSession, layout: Layout, dataset: str, as_of: dt.datetime,
                     checkpoint: str, **options) -> None:
    """Run the stream until everything landed so far is processed
    (``options`` as in :func:`start_ingest`)."""
    q = start_ingest(spark, layout, dataset, as_of, checkpoint, available_now=True, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
