"""Spark session and the shared folder that written intermediate data goes to."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC wall clocks, adaptive execution and plain Parquet timestamps; everything else stays Spark's default."""
    builder = (
        SparkSession.builder.appName("dayblotter")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Unlike the default, this has statistics, so that tests on change times can skip files.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster that folder would
    exist on one machine only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dayblotter-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/dayblotter/{purpose}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _hadoop_path(spark, path)
    return files.exists(hadoop_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    files, hadoop_path = _hadoop_path(spark, path)
    return files.getContentSummary(hadoop_path).getLength() if files.exists(hadoop_path) else 0


def remove_folder(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _hadoop_path(spark, path)
    files.delete(hadoop_path, True)


def _names(spark: SparkSession, folder: str, ending: str) -> list[str]:
    files, hadoop_path = _hadoop_path(spark, folder)
    if not files.exists(hadoop_path):
        return []
    found = (one.getPath().getName() for one in files.listStatus(hadoop_path))
    return sorted(name for name in found if name.endswith(ending))


def _text(spark: SparkSession, path: str) -> str:
    files, hadoop_path = _hadoop_path(spark, path)
    stream = files.open(hadoop_path)
    try:
        scanner = spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
        return scanner.next() if scanner.hasNext() else ""
    finally:
        stream.close()


def first_characters(spark: SparkSession, path: str, count: int) -> str:
    """The first characters of a file, and no more of it is read than they and a buffer."""
    files, hadoop_path = _hadoop_path(spark, path)
    stream = files.open(hadoop_path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        room, got = spark.sparkContext._gateway.new_array(spark._jvm.char, count), 0
        while got < count and (more := reader.read(room, got, count - got)) > 0:
            got += more
        return spark._jvm.java.lang.String.valueOf(room, 0, got)
    finally:
        stream.close()


def text_files(spark: SparkSession, folder: str, ending: str) -> dict[str, str]:
    """Name and text of the small files of a folder, in whatever store it is."""
    return {name: _text(spark, f"{folder}/{name}") for name in _names(spark, folder, ending)}


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    files, source_path = _hadoop_path(spark, source)
    return files.rename(source_path, _hadoop_path(spark, target)[1])


_KEPT_STATES = 100


def published(spark: SparkSession, folder: str) -> dict | None:
    """The state published last in a folder, with its number as `version`; None if there is none."""
    names = _names(spark, folder, ".json")
    return json.loads(_text(spark, f"{folder}/{names[-1]}")) if names else None


def publish(spark: SparkSession, folder: str, state: dict) -> dict:
    """Make a state the one that readers find, all of it at once.

    A small file takes its place among the states by one rename. A refused rename, or a state with
    that number put there by another writer, is an error, and what was published stays so. Nothing is
    ever removed before; the oldest of many states goes after.
    """
    names = _names(spark, folder, ".json")
    version = int(names[-1].removesuffix(".json")) + 1 if names else 1
    if state.get("version", version - 1) != version - 1:
        raise RuntimeError(f"another writer has published in {folder}")
    files, draft = _hadoop_path(spark, f"{folder}/_{uuid.uuid4().hex}")
    state = {**state, "version": version}
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    place = f"{folder}/{version:020d}.json"
    if path_exists(spark, place) or not _rename(spark, draft.toString(), place):
        files.delete(draft, False)
        raise RuntimeError(f"{place} could not be published")
    for name in names[: -_KEPT_STATES]:
        files.delete(_hadoop_path(spark, f"{folder}/{name}")[1], False)
    return state
