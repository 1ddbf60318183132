"""Layers whose rebuild readers never see half done: fresh version folders and one manifest that names them.

A write goes to a folder of its own, ``<root>/layer_version=<id>/...``, and changes nothing that readers use. Committing it is
the creation of one small file, ``<root>/_manifests/<number>.json``, which lists the folders that make up the layer,
partition by partition. Readers take the manifest with the highest number. A write that dies leaves a folder that
no manifest names; the layer stays as it was. A partial rebuild writes the touched partitions only, and its manifest takes
the others over from the one before.

The number of a manifest can be taken once: of two writers that commit at the same time one finds its number gone, reads
the newer manifest and tries again on top of it. A manifest has an entry for each partition of the layer, so its size is
that of a folder listing.

Appends add folders to a layer, and ``compact`` packs those that hold little into files of a wanted size: the manifest that
names the packed folder drops the packed ones in the same step, so no reader sees both.

The same log of manifests serves any small state that must change in one step (see ``streaming.gold``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path

VERSION = "layer_version"
LOG = "_manifests"


# ---- the log of manifests --------------------------------------------------------------------------


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, log = hadoop_path(spark, f"{root}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, dict | None]:
    """(number, content) of the last manifest, or of the one asked for; (0, None) before the first commit."""
    if number is None:
        number = max(_numbers(spark, root), default=0)
        if not number:
            return 0, None
    fs, path = hadoop_path(spark, f"{root}/{LOG}/{number:012d}.json")
    if not fs.exists(path):
        raise ValueError(f"{root} has no version {number}")
    stream = fs.open(path)
    try:
        text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return number, json.loads(text)


def _take(spark: SparkSession, root: str, number: int, content: dict) -> bool:
    """Create the manifest of this number; False if there is one."""
    jvm = spark.sparkContext._jvm
    fs, at = hadoop_path(spark, f"{root}/{LOG}/{number:012d}.json")
    fs.mkdirs(at.getParent())
    _, draft = hadoop_path(spark, f"{root}/{LOG}/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # a rename that fails where the name is taken: the one step in which the layer changes
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(draft, at, options)
        return True
    except Py4JJavaError:
        if number not in _numbers(spark, root):
            raise
        fs.delete(draft, False)
        return False


def commit(spark: SparkSession, root: str, change: Callable[[dict | None], dict | None]) -> int:
    """Commit ``change(last manifest's content)``; where others commit meanwhile, again on top of theirs. If ``change``
    gives None there is nothing to do. Returns the number of the manifest that holds."""
    root = root.rstrip("/")
    while True:
        number, last = read_manifest(spark, root)
        content = change(last)
        if content is None:
            return number
        if _take(spark, root, number + 1, content | {"committed": time.time()}):
            return number + 1


# ---- layers -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Staged:
    """A written version that no reader sees yet."""
    spark: SparkSession
    root: str
    version: str
    parts: tuple[str, ...]
    schema: T.StructType
    partition_by: tuple[str, ...]

    def read(self) -> DataFrame:
        return _read(self.spark, self.root, {p: [self.version] for p in self.parts}, self.schema)

    def publish(self, replace: str = "all", cleared: Sequence[str] = (), batch: tuple[str, int] | None = None,
                packed: dict[str, list[str]] | None = None) -> int:
        """Make it the layer (``all``), its partitions part of the layer (``partitions``), or its rows further rows (``nothing``).

        ``cleared`` are partitions (``a=1/b=2``) that a partial rebuild covers: they go if it has no rows for them. ``batch`` is a
        stream's name and batch number: one that was published before is not published again. ``packed`` are the
        folders, by partition, that it stands for.
        """
        if replace not in ("all", "partitions", "nothing"):
            raise ValueError("replace is all, partitions or nothing")
        if replace == "partitions" and not self.partition_by:
            raise ValueError("only a partitioned layer can be rebuilt in part")

        def change(last: dict | None) -> dict | None:
            applied = (last or {}).get("applied", {})
            if batch and applied.get(batch[0], -1) >= batch[1]:
                return None
            kept = {}
            if last and replace != "all":
                if list(self.partition_by) != last["partition_by"]:
                    raise ValueError(f"the layer is partitioned by {last['partition_by']}")
                if T.StructType.fromJson(last["schema"]).simpleString() != self.schema.simpleString():
                    raise ValueError("a partial rebuild must have the layer's columns")
                gone = set(cleared) | (set(self.parts) if replace == "partitions" else set())
                kept = {p: v for p, v in last["parts"].items() if p not in gone}
            for p, folders in (packed or {}).items():
                if not set(folders) <= set(kept.get(p, [])):
                    raise RuntimeError(f"{self.root}: what was packed has been replaced meanwhile")
                kept[p] = [v for v in kept[p] if v not in folders]
            for p in self.parts:
                kept[p] = [*kept.get(p, []), self.version]
            return {"parts": {p: v for p, v in kept.items() if v}, "schema": json.loads(self.schema.json()),
                    "partition_by": list(self.partition_by), "applied": applied | ({batch[0]: batch[1]} if batch else {})}

        return commit(self.spark, self.root, change)


def _folders(fs, path, depth: int) -> list[str]:
    """Names of the folders ``depth`` levels below a path, joined by slashes."""
    if depth == 0:
        return [""]
    inner = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()]
    return [f"{p.getName()}/{x}".rstrip("/") for p in inner for x in _folders(fs, p, depth - 1)]


def stage(df: DataFrame, root: str, partition_by: Sequence[str] = (), observe: tuple | None = None) -> Staged:
    """Write a new version of a Parquet layer. With ``partition_by`` the rows are rebalanced on these columns first, so that
    each partition has few files and a large one several tasks. ``observe`` is ``(Observation, metric columns)``."""
    spark, root = df.sparkSession, root.rstrip("/")
    version, schema = uuid.uuid4().hex, df.schema
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    target = f"{root}/{VERSION}={version}"
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    writer.parquet(target)
    parts = _folders(*hadoop_path(spark, target), len(partition_by))
    return Staged(spark, root, version, tuple(parts), schema, tuple(partition_by))


def _folder(root: str, version: str, part: str) -> str:
    return f"{root}/{VERSION}={version}/{part}".rstrip("/")


def _read(spark: SparkSession, root: str, parts: dict[str, list[str]], schema: T.StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [_folder(root, v, p) for p, versions in parts.items() for v in versions]
    with_version = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(with_version).option("basePath", root).parquet(*paths).select(*[f"`{c}`" for c in schema.names])


def read_layer(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The layer as last committed, or as of a version: one scan over the folders that the manifest names."""
    root = root.rstrip("/")
    _, content = read_manifest(spark, root, version)
    if content is None:
        raise ValueError(f"no layer was committed at {root}")
    return _read(spark, root, content["parts"], T.StructType.fromJson(content["schema"]))


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = (), replace: str = "all",
                  cleared: Sequence[str] = ()) -> DataFrame:
    """Write a layer, or some of its partitions, commit it and return it."""
    stage(df, root, partition_by).publish(replace, cleared)
    return read_layer(df.sparkSession, root)


def append_batch(df: DataFrame, root: str, stream: str, batch: int, partition_by: Sequence[str] = ()) -> int:
    """Add a micro-batch of a stream to a layer, once: for ``foreachBatch``. A replayed batch changes nothing."""
    root = root.rstrip("/")
    number, last = read_manifest(df.sparkSession, root)
    if last and last.get("applied", {}).get(stream, -1) >= batch:
        return number
    return stage(df, root, partition_by).publish("nothing", batch=(stream, batch))


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Names packed by size, the largest first, each into the first bin that has room for it; none holds more than ``target``
    unless it is one name."""
    packed: list[tuple[int, list[str]]] = []
    room: list[int] = []  # bins that may still take something
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for i in room:
            if packed[i][0] + size <= target:
                packed[i] = (packed[i][0] + size, [*packed[i][1], name])
                break
        else:
            packed.append((size, [name]))
            room.append(len(packed) - 1)
        room = [i for i in room[-64:] if packed[i][0] < target]
    return [names for _, names in packed]


def compact(spark: SparkSession, root: str, target_bytes: int = 256 << 20) -> int:
    """Pack the folders of a layer that hold less than half of ``target_bytes``, those of one partition together, into one file for each
    ``target_bytes`` about. Rows stay as they are, readers go on reading what they read, and a run that dies leaves a folder
    that nobody reads. Returns the number of folders packed.

    What is small is told from the folders' sizes in the file system; the rows of all that is to be packed are moved in one job.
    """
    root = root.rstrip("/")
    _, content = read_manifest(spark, root)
    if content is None:
        raise ValueError(f"no layer was committed at {root}")
    by = content["partition_by"]
    # per partition, the small folders in bins; each bin becomes a file
    chosen: dict[str, list[str]] = {}
    numbered: list[tuple[str, str, int]] = []
    n_bins = 0
    for part, versions in content["parts"].items():
        sizes = {}
        for v in versions:
            fs, path = hadoop_path(spark, _folder(root, v, part))
            sizes[v] = fs.getContentSummary(path).getLength()
        small = {v: n for v, n in sizes.items() if n < target_bytes / 2}
        for names in bins(small, target_bytes):
            if len(names) > 1:
                chosen.setdefault(part, []).extend(names)
                numbered += [(v, part, n_bins) for v in names]
                n_bins += 1
    if not numbered:
        return 0
    schema = T.StructType.fromJson(content["schema"])
    with_version = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    small = spark.read.schema(with_version).option("basePath", root).parquet(*[_folder(root, v, p) for p, folders in chosen.items() for v in folders])
    # a row's folder is its version and partition: one row in the list for each folder that is read
    inside = F.regexp_extract(F.col("_metadata.file_path"), rf"{VERSION}=[0-9a-f]+(?:/(.*))?/[^/]+$", 1)
    listed = spark.createDataFrame([(v, p, b) for v, p, b in numbered], f"{VERSION} string, __part string, __bin int")
    dealt = small.withColumn("__part", inside).join(F.broadcast(listed), [VERSION, "__part"]).repartition(n_bins, "__bin")
    version = uuid.uuid4().hex
    rows = dealt.select(*[f"`{c}`" for c in schema.names])
    target = f"{root}/{VERSION}={version}"
    (rows.write.partitionBy(*by) if by else rows.write).parquet(target)
    parts = _folders(*hadoop_path(spark, target), len(by))
    Staged(spark, root, version, tuple(parts), schema, tuple(by)).publish("nothing", packed=chosen)
    return len(numbered)


def vacuum(spark: SparkSession, root: str, keep: int = 1, older_than_s: float = 24 * 3600) -> list[str]:
    """Delete the folders that none of the last ``keep`` manifests names and that are older than ``older_than_s`` (a
    younger one may be a write under way), and the manifests before these. Returns the folders' names."""
    if keep < 1:
        raise ValueError("keep is at least 1")
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    live = {f"{VERSION}={v}" for n in numbers[-keep:] for folders in read_manifest(spark, root, n)[1].get("parts", {}).values() for v in folders}
    fs, top = hadoop_path(spark, root)
    oldest = (time.time() - older_than_s) * 1000
    gone = []
    # manifests first: a reader that has one of the kept ones finds all it names
    for n in numbers[:-keep]:
        fs.delete(hadoop_path(spark, f"{root}/{LOG}/{n:012d}.json")[1], False)
    for s in fs.listStatus(top) if numbers else []:
        name = s.getPath().getName()
        if name.startswith(f"{VERSION}=") and name not in live and s.getModificationTime() <= oldest:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
