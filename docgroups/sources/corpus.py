"""Corpus tables ``(doc_id, text, label, label_name)`` from files and tables."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgroups.functions.text import clean_post, known_text
from docgroups.operators.labels import encode_labels
from docgroups.session import cut

# Key, text and truth columns of the known tables.
TABLES = {
    "documents": (["doc_id"], "text", "lang"),
    "conversations": (["conv_id", "turn"], "text", "role"),
}
# The folder of rows without a value, and the characters a folder's name cannot hold, as Spark's writer has them.
NO_GROUP = "__HIVE_DEFAULT_PARTITION__"
# What Spark escapes in the path of a file.
QUOTED = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]""")
LISTED_AT_ONCE = 4096  # files of a batch of paths
POSTS_A_TASK = 20_000
READ_BYTES = 4 * 1024 * 1024  # of texts in a batch
UNSAFE = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header, quoted multi-line ``Text`` and a ``Category`` column.

    A missing path fails with Spark's PATH_NOT_FOUND. Multi-line files are not split, so many files
    of moderate size read faster than one large file.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    missing = {"Text", "Category"} - set(raw.columns)
    if missing:
        raise ValueError(f"{path} lacks columns {sorted(missing)}")
    rows = raw.select(
        F.monotonically_increasing_id().alias("doc_id"),
        known_text(F.col("Text")).alias("text"),
        F.col("Category").alias("label_name"),
    )
    return encode_labels(rows, "label_name").select("doc_id", "text", "label", "label_name")


def write_posts(rows: DataFrame, group: str, path: str) -> None:
    """One file per row, ``path/<group>=<value>/<post>``: its ``text`` and a line feed. Rows without a group go to Spark's folder for these.

    Each task writes its posts itself where Arrow knows the file system: Spark's writer opens a new Hadoop stream and commits each file,
    tens of milliseconds a post. Names follow the row's place, so a task that is run again writes the same files.
    """
    texts = rows.select(F.coalesce(F.nullif(F.col(group).cast("string"), F.lit("")), F.lit(NO_GROUP)).alias("group"), known_text(F.col("text")).alias("text"))
    uri = path if "://" in path else path.removeprefix("file:")
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        texts.withColumnRenamed("group", group).write.partitionBy(group).option("maxRecordsPerFile", 1).text(path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(uri)
        part, n, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            for value, text in zip(batch["group"].to_pylist(), batch["text"].to_pylist()):
                folder = f"{root}/{group}={UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', value)}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/post-{part:05d}-{n}.txt", compression=None) as out:
                    out.write(text.encode() + b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    texts.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _children(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """``(path, is a folder, size)`` of what a folder holds; of a local one an entry at a time."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for x in found:
                yield x.path, x.is_dir(), 0 if x.is_dir() else x.stat().st_size
    else:
        for x in store.get_file_info(fs.FileSelector(folder)):
            yield x.path, x.type == fs.FileType.Directory, x.size or 0


def _post_paths(store: fs.FileSystem, folder: str) -> Iterator[str]:
    """Files below a folder that are not empty, as Spark's readers find them."""
    for path, is_folder, size in _children(store, folder):
        if _hidden(path.rsplit("/", 1)[-1]):
            continue
        if is_folder:
            yield from _post_paths(store, path)
        elif size:
            yield path


def _stored_posts(spark: SparkSession, path: str) -> DataFrame | None:
    """``(file, value)`` of all files below ``path``, found and read by tasks; None where Arrow does not know the store or the path.

    Spark's reader lists the files on the driver and keeps each of them there. Here the driver sees the folders in ``path``, one by one.
    """
    context = spark.sparkContext
    asked = context._jvm.org.apache.hadoop.fs.Path(path)
    uri = asked.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(asked).toUri()
    scheme, host = uri.getScheme(), uri.getAuthority()
    place = f"{scheme}://{host or ''}{uri.getRawPath()}"
    try:
        store, root = fs.FileSystem.from_uri(place)
        if store.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    # Some of Arrow's paths start with the host, which for them is a bucket.
    start = f"{scheme}:{f'//{host}' if host else ''}" if root.rstrip("/") == uri.getPath().rstrip("/") else f"{scheme}://"
    tops = [(x, is_folder, size) for x, is_folder, size in _children(store, root) if not _hidden(x.rsplit("/", 1)[-1]) and (is_folder or size)]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(place)
        for batch in batches:
            for top, is_folder in zip(batch["top"].to_pylist(), batch["is_folder"].to_pylist()):
                paths = _post_paths(store, top) if is_folder else iter([top])
                while some := list(itertools.islice(paths, LISTED_AT_ONCE)):
                    yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(place)
        for batch in batches:
            files, values, held = [], [], 0
            for path in batch["path"].to_pylist():
                with store.open_input_stream(path, compression="detect") as post:
                    values.append(post.read())
                files.append(f"{start}{QUOTED.sub(lambda m: ''.join(f'%{x:02X}' for x in m[0].encode()), path)}")
                held += len(values[-1])
                if held >= READ_BYTES:
                    yield pa.RecordBatch.from_pydict({"file": files, "value": pa.array(values, pa.binary())})
                    files, values, held = [], [], 0
            if files:
                yield pa.RecordBatch.from_pydict({"file": files, "value": pa.array(values, pa.binary())})

    top = spark.createDataFrame([x[:2] for x in tops], "top string, is_folder boolean").repartition(max(1, len(tops)))
    paths = cut(top.mapInArrow(listed, "path string"))
    parts = max(context.defaultParallelism, -(-paths.count() // POSTS_A_TASK))
    posts = paths.repartition(parts, "path").mapInArrow(read, "file string, value binary")
    return posts.select("file", F.col("value").cast("string").alias("value"))


def read_posts(spark: SparkSession, path: str, clean: bool = True, depth: int = 1) -> DataFrame:
    """One post per file, the folder name being its group: ``path/<group>/<post>``.

    The group is the folder ``depth`` levels above the file; of a folder ``name=value`` it is the value. ``file`` is the
    whole path, which no two posts share. The files, however many, are opened once, and their texts kept in a table.
    """
    files = _stored_posts(spark, path)
    if files is None:
        files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        files = files.select(F.col("_metadata.file_path").alias("file"), "value")
    parts = F.split("file", "/")
    text = known_text(F.col("value"))
    rows = files.select(
        F.xxhash64("file").alias("doc_id"),
        (clean_post(text) if clean else text).alias("text"),
        F.regexp_replace(F.element_at(parts, -1 - depth), "^[^=]*=", "").alias("label_name"),
        "file",
    )
    return encode_labels(cut(rows), "label_name").select("doc_id", "text", "label", "label_name", "file")


def read_table(spark: SparkSession, folder: str, name: str = "documents", labelled: bool = True) -> DataFrame:
    """A Parquet table as a corpus; the truth column of each known table is its label name.

    A key of several columns is hashed to one id. Without ``labelled`` the codes are left out and
    nothing is read ahead.
    """
    key, text, label = TABLES[name]
    doc_id = F.col(key[0]) if len(key) == 1 else F.xxhash64(*key)
    rows = spark.read.parquet(f"{folder}/{name}.parquet").select(
        doc_id.alias("doc_id"),
        known_text(F.col(text)).alias("text"),
        F.col(label).alias("label_name"),
    )
    if not labelled:
        return rows
    return encode_labels(rows, "label_name").select("doc_id", "text", "label", "label_name")
