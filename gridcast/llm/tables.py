"""Reading the given tables, and intermediate tables in the shared scratch folder that go when they are used up."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gridcast.session import scratch_path

__all__ = ["Passing", "bounded_batches", "passing", "spread", "stage", "table"]


#: Bytes of an Arrow batch between Spark and a Python worker. Rows are counted by themselves, so that batches of long
#: texts stay as small as those of short ones; a single longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes (runtime setting; a smaller one stays)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


class Passing:
    """The tables written inside a `passing()` block."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._tables, self._kept = spark, [], []

    def add(self, path: str, read: DataFrame) -> None:
        self._tables.append((path, read))

    def keep(self, *reads: DataFrame) -> None:
        """These are still read by what the block returns."""
        self._kept += reads

    def split(self) -> tuple[list, list]:
        kept = [t for t in self._tables if any(t[1] is k for k in self._kept)]
        return kept, [t for t in self._tables if not any(t is k for k in kept)]

    def read_by(self, df: DataFrame) -> bool:
        """Whether the DataFrame reads one of them."""
        return any(path.rsplit("/", 1)[1] in file for file in df.inputFiles() for path, _ in self._tables)

    def of(self, spark: SparkSession) -> bool:
        return self._spark is spark

    def delete(self, tables: list | None = None) -> None:
        for path, _ in self._tables if tables is None else tables:
            where = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        self._tables = [t for t in self._tables if tables is not None and t not in tables]


_OPEN: list[Passing] = []


@contextmanager
def passing(spark: SparkSession, keep_all: bool = False) -> Iterator[Passing]:
    """Tables staged inside are deleted at the end, but for those named by keep(); these go on to the block
    around, if there is one. Nothing is deleted after an error."""
    own = Passing(spark)
    _OPEN.append(own)
    try:
        yield own
    finally:
        _OPEN.pop()
    if not keep_all:
        kept, used_up = own.split()
        own.delete(used_up)
        for path, read in kept if _OPEN else ():
            _OPEN[-1].add(path, read)


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: lineage ends here, and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    bounded_batches(df.sparkSession)
    df.write.options(**options).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    if _OPEN:
        _OPEN[-1].add(path, read)
    return read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession) -> int:
    """Partitions to deal rows out to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
