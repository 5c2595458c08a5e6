"""One directory layout for every writer of a table, and what is kept beside it.

Data files lie in ``chunk=.../`` only, whoever wrote them: a batch append, any
number of streams, a compaction. Beside them (names with an underscore, which
readers pass over):

* ``_ledger/batches/<writer>/<batch>.json``: one entry per published batch, with
  its rows and seconds. A batch that has an entry is never written again, so a
  replayed micro-batch adds nothing; the entries are also the streams' metrics.
* ``_staging/<name>``: a batch's files until all are written. They are then
  renamed into the chunks one by one, under names that begin with writer and
  batch. A job that stops halfway goes on with what is left in staging: nothing
  is written twice, nothing lost.
* ``_ledger/swaps/<id>.json``: a compaction's intent, which files replace which.
  While it is there, ``hidden`` names the files that readers pass over: the new
  ones until all are in place (``<id>.moved``), then the old ones. Whoever works
  on the table next finishes it.

Only small files and renames pass through the driver: as many as a batch or a
swap has files.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

#: Compacted files are called so; a chunk that has others beside them is dirty.
COMPACTED = "compact-"
_CODEC = {"compression": "zstd"}


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path in its terms."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class _Files:
    """The few file operations needed, on whatever file system the table is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.fs, _ = filesystem(spark, root)
        self.root, self._path, self._jvm = root.rstrip("/"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jvm

    def at(self, rel: str):
        return self._path(f"{self.root}/{rel}")

    def exists(self, rel: str) -> bool:
        return self.fs.exists(self.at(rel))

    def names(self, rel: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(rel))) if self.exists(rel) else []

    def put(self, rel: str, content: dict) -> None:
        """All or nothing: written aside, then renamed."""
        aside = self.at(f"_staging/{rel.replace('/', '-')}.tmp")
        out = self.fs.create(aside, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        self.move(aside, self.at(rel))

    def get(self, rel: str) -> dict:
        stream = self.fs.open(self.at(rel))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def move(self, a, b) -> None:
        self.fs.mkdirs(b.getParent())
        if self.fs.exists(b):  # a copy that an interrupted rename left, where renames are copies
            self.fs.delete(b, False)
        if not self.fs.rename(a, b):
            raise OSError(f"cannot rename {a} to {b}")

    def delete(self, rel: str) -> None:
        self.fs.delete(self.at(rel), True)

    def staged(self, stage: str) -> list[tuple[str, str]]:
        """(chunk directory, file) of a staging folder."""
        return [(c, f) for c in self.names(stage) if c.startswith("chunk=") for f in self.names(f"{stage}/{c}") if f.endswith(".parquet")]


def arranged(rows: DataFrame, *within, tasks: int | None = None) -> DataFrame:
    """Rows gathered by chunk and ordered.

    The rebalance hint makes partitions of Spark's advisory size: a chunk with
    most of the rows is split, small ones share a task, and the input is
    computed once. ``tasks``: that many range partitions by (chunk, timestamp)
    instead. They write many small chunks side by side, but Spark computes the
    input a second time for a sample of it."""
    rows = rows.repartitionByRange(tasks, "chunk", "timestamp") if tasks else rows.hint("rebalance", "chunk")
    return rows.sortWithinPartitions("chunk", *within)


def publish(rows: DataFrame, path: str, writer: str, batch: int | str, within=("timestamp",), table: str = "",
            max_records_per_file: int = 5_000_000, tasks: int | None = None) -> dict:
    """Add rows (with ``chunk``) to the table once per (writer, batch); gives the
    ledger's entry, and ``new`` = whether this call wrote it."""
    spark = rows.sparkSession
    files, name = _Files(spark, path), f"{writer}-{batch}"
    entry, stage = f"_ledger/batches/{writer}/{batch}.json", f"_staging/{writer}-{batch}"
    if files.exists(entry):
        return files.get(entry) | {"new": False}
    if not files.exists(f"{stage}/_rows.json"):  # nothing is published before all is staged
        began, seen = time.time(), Observation()
        (arranged(rows, *within, tasks=tasks).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**_CODEC)
         .option("maxRecordsPerFile", max_records_per_file).partitionBy("chunk").parquet(f"{path}/{stage}"))
        files.put(f"{stage}/_rows.json", {"rows": int(seen.get.get("n") or 0), "elapsed_s": time.time() - began})
    done = files.get(f"{stage}/_rows.json")
    for chunk, f in files.staged(stage):
        files.move(files.at(f"{stage}/{chunk}/{f}"), files.at(f"{chunk}/{name}-{f}"))
    row = {"table": table, "writer": writer, "batch": str(batch), "written_at": time.time(), **done}
    files.put(entry, row)
    files.delete(stage)
    return row | {"new": True}


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: (table, writer, batch, rows, elapsed_s, written_at) per published batch."""
    schema = "table string, writer string, batch string, rows long, elapsed_s double, written_at double"
    if not _Files(spark, path).exists("_ledger/batches"):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("recursiveFileLookup", "true").json(f"{path}/_ledger/batches")
            .withColumn("written_at", F.timestamp_micros((F.col("written_at") * 1_000_000).cast("long"))))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, state, files, bytes) of every chunk: ``raw`` (never compacted),
    ``compacted``, or ``dirty`` (rows came since). Read from the file names; no
    file is opened, and Spark lists large tables in parallel."""
    schema = "chunk date, state string, files long, bytes long"
    if not any(c.startswith("chunk=") for c in _Files(spark, path).names("")):
        return spark.createDataFrame([], schema)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", path).load(f"{path}/chunk=*").select(
        F.to_date(F.col("chunk").cast("string")).alias("chunk"), "length", F.element_at(F.split("path", "/"), -1).startswith(COMPACTED).alias("c"))
    state = F.when(F.bool_and("c"), "compacted").when(F.bool_or("c"), "dirty").otherwise("raw")
    return found.groupBy("chunk").agg(state.alias("state"), F.count("*").alias("files"), F.sum("length").alias("bytes"))


def swap(spark: SparkSession, path: str, make, chunks: list[str], name: str) -> None:
    """Replace the files that these chunks have now by what ``make`` gives of
    their rows. Files that come meanwhile stay."""
    files, stage = _Files(spark, path), f"_staging/{COMPACTED}{name}"
    old = [f"chunk={c}/{f}" for c in chunks for f in files.names(f"chunk={c}") if f.endswith(".parquet")]
    make([x.removeprefix("chunk=") for x in old]).write.mode("overwrite").options(**_CODEC).partitionBy("chunk").parquet(f"{path}/{stage}")
    new = [[f"{stage}/{c}/{f}", f"{c}/{COMPACTED}{name}-{f}"] for c, f in files.staged(stage)]
    files.put(f"_ledger/swaps/{name}.json", {"stage": stage, "new": new, "old": old})
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> list[str]:
    """Carry out every intent that is still there, from wherever it stopped."""
    files = _Files(spark, path)
    names = [n[:-5] for n in files.names("_ledger/swaps") if n.endswith(".json")]
    for name in names:
        intent, moved = files.get(f"_ledger/swaps/{name}.json"), f"_ledger/swaps/{name}.moved"
        if not files.exists(moved):
            for a, b in intent["new"]:
                if files.exists(a):
                    files.move(files.at(a), files.at(b))
            files.put(moved, {})
        for f in intent["old"]:
            files.delete(f)
        files.delete(f"_ledger/swaps/{name}.json")  # before the mark, which says what readers pass over
        files.delete(moved)
        files.delete(intent["stage"])
    return names


def hidden(spark: SparkSession, path: str) -> list[str]:
    """``<chunk>/<file>`` of the files that readers pass over while a swap is under way."""
    files, out = _Files(spark, path), []
    names = files.names("_ledger/swaps")
    for n in names:
        if n.endswith(".json"):
            intent = files.get(f"_ledger/swaps/{n}")
            out += intent["old"] if f"{n[:-5]}.moved" in names else [b for _, b in intent["new"]]
    return [x.removeprefix("chunk=") for x in out]


def among(files: list[str]) -> Column:
    """True for rows of these ``<chunk>/<file>``: one task's files have one name in all chunks."""
    return F.concat_ws("/", F.col("chunk").cast("string"), "_metadata.file_name").isin(files)
