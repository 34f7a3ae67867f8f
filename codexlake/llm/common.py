"""Shared plumbing of the operators: scratch tables, Arrow buffers, splitters.

Scratch tables are Parquet folders under the folder the cluster names in
``spark.checkpoint.dir``; a lost executor only costs the tasks it was running.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space that separates words in the query contracts.
WORD = r"[^\x20\x09-\x0D]+"


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "float": T.FloatType()}


def row_type(**fields: str) -> T.StructType:
    """A struct of plain types; "long[]" is an array. Needs no session."""
    return T.StructType([T.StructField(k, T.ArrayType(_TYPES[v[:-2]]) if v.endswith("[]") else _TYPES[v]) for k, v in fields.items()])


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the
    context's checkpoint folder. Where neither is set, a folder of this machine
    if it is the only one (master local[...]); on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    return f"file://{tempfile.gettempdir()}/codexlake-scratch"


#: Rows and bytes of a batch that goes to a Python worker. Spark's own bounds are
#: by rows alone or far larger, and texts may be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``BATCH``, never raises them."""
    for key, most in BATCH.items():
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


class Scratch:
    """Written tables that cut lineage; removed when the JVM ends, or by drop()."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{shared_root(spark).rstrip('/')}/codexlake-{name}-{uuid.uuid4().hex}"
        self.seq = 0
        bound_batches(spark)
        path, fs = self._at(self.base)
        fs.mkdirs(path)  # deleteOnExit passes over what isn't there yet
        fs.deleteOnExit(path)

    def _at(self, where: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.seq += 1
        where = f"{self.base}/{self.seq:03d}-{name}"
        # shuffle files of the write aren't needed once the table stands
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        had = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            df.write.parquet(where)
        finally:
            self.spark.conf.set(key, had)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._scratch = where
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path, fs = self._at(df._scratch)
            fs.delete(path, True)


#: Rows of a few numbers that may be broadcast: some 100 MB.
FEW = 2_000_000


def few(df: DataFrame, most: int = FEW) -> DataFrame:
    """df, marked for broadcast if it has at most ``most`` rows (counted). Above
    that Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c):
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_text(c):
    """An id as text; a null id is the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def fold_of(c, k: int):
    """crc32 of the id's text modulo k."""
    return F.crc32(id_text(c).cast("binary")) % k


#: Bytes of text that the stages of the pipeline measure at a time: their tables take
#: some 60 bytes for each, and what a Python worker once took it keeps.
PIECE = 1 << 18


def text_parts(arr: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a text column with at most ``limit`` bytes (one row at
    least): first row, end row, their UTF-8 bytes and the rows' offsets in
    them. Null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary()).fill_null(b"")
    n = len(arr)
    if not n:
        return
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], (offs[a : b + 1] - offs[a])
        a = b


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
