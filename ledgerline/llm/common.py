"""Helpers shared by the corpus operators: reading, staging, ranks over a whole table."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

import pyarrow as pa
from py4j.java_gateway import JavaObject, JVMView
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: The word of every contract here: a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

#: What is still there: the JVM and its settings outlive a stopped session.
_staged: dict[str, tuple[JVMView, JavaObject]] = {}

#: After every so many staged tables the driver gives unused memory back: its plans, not the data, are what it holds most of.
GIVE_BACK = 4
_written = count(1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remove(jvm: JVMView, conf: JavaObject, path: str) -> None:
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def give_back(spark: SparkSession) -> int:
    """Memory that the driver's JVM took and no longer uses goes back to the system: the heap shrinks to what is in use and what the VM
    grows by, and so does the memory of the C library, which keeps what compiling and short-lived threads have freed, in one pool for each
    of many threads. Returns the bytes by which the latter shrank; 0 where the VM has no such command."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    jvm.System.gc()

    def array(kind: str, *items: object) -> JavaObject:
        out = gateway.new_array(getattr(jvm.java.lang, kind), len(items))
        for i, x in enumerate(items):
            out[i] = x
        return out

    try:
        of = jvm.java.lang.Class.forName
        name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        kinds = array("Class", name.getClass(), of("java.lang.String"), array("Object").getClass(), array("String").getClass())
        invoke = of("javax.management.MBeanServer").getMethod("invoke", kinds)  # the server's own class is not open to others
        said = invoke.invoke(server, array("Object", name, "systemTrimNativeHeap", array("Object"), array("String")))
    except Py4JError:
        return 0
    freed = re.search(r"\(-(\d+)([BKMG]?)", said)
    return int(freed[1]) << "BKMG".index(freed[2] or "B") * 10 if freed else 0


class Staged:
    """A frame written once to the shared folder and read back, so that what follows neither repeats the work
    nor depends on an executor's disk. ``drop()`` removes it; what is left goes when the driver ends."""

    def __init__(self, df: DataFrame, name: str, rows_a_file: int = 0):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/ledgerline/{name}-{uuid.uuid4().hex}"
        _staged[self.path] = (self.spark._jvm, self.spark._jsc.hadoopConfiguration())
        df.write.option("maxRecordsPerFile", rows_a_file).parquet(self.path)
        if next(_written) % GIVE_BACK == 0:
            give_back(self.spark)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        if self.path in _staged:
            _remove(*_staged.pop(self.path), self.path)


@contextmanager
def scratch() -> Iterator[list[Staged]]:
    """What is staged inside goes at the end, but for what is put on the list."""
    before, keep = set(_staged), []
    yield keep
    kept = {x.path for x in keep}
    for path in [p for p in _staged if p not in before and p not in kept]:
        _remove(*_staged.pop(path), path)


class Bucketed:
    """The same in buckets by a column: what is joined or grouped by it is not shuffled. A table of the session that has its files
    in the shared folder."""

    def __init__(self, df: DataFrame, name: str, by: str, n: int):
        self.spark, unique = df.sparkSession, uuid.uuid4().hex
        self.path = f"{shared_dir(self.spark)}/ledgerline/{name}-{unique}"
        self.table = f"{name}_{unique}".replace("-", "_")
        _staged[self.path] = (self.spark._jvm, self.spark._jsc.hadoopConfiguration())
        df.write.bucketBy(n, by).option("path", self.path).format("parquet").saveAsTable(self.table)
        self.df = self.spark.table(self.table)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.path in _staged:
            _remove(*_staged.pop(self.path), self.path)


@atexit.register
def _tidy() -> None:
    for path, (jvm, conf) in _staged.items():
        try:
            _remove(jvm, conf, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            return


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends, not when the driver forgets it: for operators that go over the
    data in rounds, each of which stages its result. A part that is lost later is computed again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bounded_texts(df: DataFrame, order: str, rows: int, size: int) -> list[Row]:
    """Rows of ``df`` (with text) on the driver, in the order of a hash: as many as have ``size`` bytes of text together, ``rows``
    at most. No text is cut; one of over a sixteenth of ``size`` is not among them."""
    fits = df.withColumn("__size", F.octet_length(F.coalesce("text", F.lit("")))).filter(F.col("__size") <= size // 16)
    held, last = 0, None
    for at, n in fits.select(order, "__size").orderBy(order).limit(rows).collect():
        held += n
        if held > size:
            break
        last = at
    if last is None:
        return []
    return fits.filter(F.col(order) <= last).drop("__size").orderBy(order, "text").limit(rows).collect()


def parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices, so that a worker holds the Python texts of few rows at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text, unsigned; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def small_or_not(df: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The frame, marked for broadcast if it has at most ``rows`` rows, and its count up to rows + 1."""
    n = df.limit(rows + 1).count()
    return (F.broadcast(df) if n <= rows else df), n
