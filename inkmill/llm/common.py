"""Helpers shared by the training-data operators.

* ``map_rows`` runs one Python function per row inside Arrow batches and flushes output in bounded
  batches, so that memory follows the batch size and not the partition size.
* ``store`` cuts lineage by a Parquet table in the cluster's shared checkpoint folder; a lost executor
  then costs a re-read and no recomputation.
* ``components`` labels the nodes of an edge table by their smallest reachable node.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows, and characters or bytes, after which a batch of output rows is sent on.
FLUSH_ROWS = 2_000
FLUSH_SIZE = 4_000_000
#: Bytes after which Spark ends an Arrow batch of input rows; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
#: Bytes of Parquet's buffers and pages: arrays of over half a megabyte are costly for the JVM, which gives each regions
#: of its own and grows the heap for them.
BUFFER_BYTES = 1 << 18
#: How stored tables are written: row groups of which a task can hold several.
WRITE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(16 << 20)}
#: Bytes of a table that may be broadcast.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is configured, a temporary one serves a local master (tests); a cluster must name one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="inkmill-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.options(**WRITE_OPTIONS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, tag: str) -> str:
    """A place of its own in the shared folder, to be deleted with the stored tables."""
    _stored.append(f"{_own_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return _stored[-1]


#: Paths of the tables stored and not yet dropped, the oldest first.
_stored: list[str] = []


def stored() -> list[str]:
    return list(_stored)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables; nothing that still reads them may be run afterwards."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if p in _stored:
            _stored.remove(p)


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has stored; results that read them must be written by then."""
    drop(spark, [_own_dir(spark)])
    _stored.clear()


def small(table: DataFrame, limit: int | None = None) -> bool:
    """May ``table``, a stored one, be broadcast?  By the bytes of its values, with room for each row's overhead."""
    limit = BROADCAST_BYTES if limit is None else limit
    if table.count() * 64 > limit:
        return False
    return (table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 64)).first()[0] or 0) <= limit


#: Spark's limits of a batch between Parquet, JVM and Python: name, the defaults, and what long texts need.
BATCH_LIMITS = (
    ("spark.sql.execution.arrow.maxBytesPerBatch", (None, "67108864b", "64MB"), f"{BATCH_BYTES}b"),
    ("parquet.read.allocation.size", (None, "8388608"), str(BUFFER_BYTES)),
    ("parquet.page.size", (None, "1048576"), str(BUFFER_BYTES)),
    ("parquet.dictionary.page.size", (None, "1048576"), str(BUFFER_BYTES)),
)


def bound_batches(spark: SparkSession) -> None:
    """Lower Spark's limits of a batch from their defaults; a session's own limits stay."""
    for name, defaults, value in BATCH_LIMITS:
        if spark.conf.get(name, None) in defaults:
            spark.conf.set(name, value)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # not the GNU C library


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def _size(row: tuple) -> int:
    return sum(len(v) for v in row if isinstance(v, (str, bytes)))


def batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pack row tuples into record batches of bounded size."""

    def packed(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += _size(row)
        if len(held) >= FLUSH_ROWS or size >= FLUSH_SIZE:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def map_rows(df: DataFrame, schema: str, rows: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """``rows`` gets an iterator over the input tuples of a partition and yields output tuples."""
    spark_schema = schema_of(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tuples() -> Iterator[tuple]:
            for batch in source:
                # slices keep the Python copies of rows few at a time
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        yield from batches(rows(tuples()), arrow)
        release_memory()

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, spark_schema)


def digest(text: str):
    """The key of a text, whatever row it is in; null for a null text."""
    return F.unhex(F.sha1(F.col(text)))


def edit_texts(df: DataFrame, text: str, edits: DataFrame, edit: Callable, length: str | None = None) -> DataFrame:
    """``df`` with ``edit(text, hit)`` in all rows whose text ``edits(digest, hit)`` names, each digest once.

    An edit belongs to a text: rows without a key, or that share one, are treated like any other.  An edit that
    gives None drops its rows.  All columns of ``df`` stay; ``length`` names one that then holds the text's code
    points.  ``edits`` is a stored table.
    """
    names = df.columns
    mark = fresh("hit", names)
    table = edits.select(F.col("digest").alias(f"{mark}_d"), F.col("hit").alias(mark))
    keyed = df.withColumn(f"{mark}_k", digest(text))
    joined = keyed.join(F.broadcast(table) if small(edits) else table, F.col(f"{mark}_k") == F.col(f"{mark}_d"), "left").select(*names, mark)
    schema = to_arrow_schema(df.schema)
    place = names.index(text)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            hit, columns = batch.column(len(names)), batch.columns[:-1]
            if hit.null_count < batch.num_rows:
                new = {i: edit(columns[place][i].as_py(), hit[i].as_py()) for i in range(batch.num_rows) if hit[i].is_valid}
                columns[place] = pa.array([new[i] if i in new else columns[place][i].as_py() for i in range(batch.num_rows)], schema.field(place).type)
                if length in names:
                    at = names.index(length)
                    columns[at] = pa.array([len(new[i] or "") if i in new else n for i, n in enumerate(columns[at].to_pylist())], schema.field(at).type)
                stays = pa.array([new.get(i, "") is not None for i in range(batch.num_rows)], pa.bool_())
                columns = [c.filter(stays) for c in columns]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        release_memory()

    bound_batches(df.sparkSession)
    return joined.mapInArrow(run, df.schema)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that begins like none of ``taken``."""
    while any(t.lower().startswith(name) for t in taken):
        name += "_"
    return name


# -- connected components ------------------------------------------------------------------------

#: Up to so many edges one executor task finishes the union-find; beyond, rounds of star contraction do.
LOCAL_EDGES = 16_384


def _forest(pairs: Iterator[tuple]) -> Iterator[tuple]:
    """Replace the edges of a partition by (node, smallest node) stars with the same components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    for x in root:
        if (top := find(x)) != x:
            yield x, top


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, component) for every node of ``edges(a long, b long)`` that is not its component's smallest.

    Each partition first contracts its edges to a spanning forest.  Small edge tables are then finished in
    one task, whose input is at most ``local_edges`` rows by a count.  Larger ones go through alternating
    star contractions: every node points its larger neighbours, then its smaller ones, at the smallest
    node it knows, until nothing changes.  An empty table gives an empty result.
    """
    ddl = "a long, b long"
    began = len(stored())
    stars = store(map_rows(edges.select("a", "b"), ddl, _forest), "edges")
    while True:
        n = stars.count()
        if n <= local_edges:
            return map_rows(stars.coalesce(1), "node long, component long", _forest)
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = store(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "low")
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = store(large.filter("a <> b").distinct(), "large")
        low = store(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.filter("a <> b").union(low).distinct()
        after = store(small, "stars")
        done = after.count() == n and after.exceptAll(stars).isEmpty()
        drop(stars.sparkSession, stored()[began:-1])
        if done:
            return after.select(F.col("a").alias("node"), F.col("b").alias("component"))
        stars = after
