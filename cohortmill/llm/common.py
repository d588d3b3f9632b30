"""Small helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_root

#: Rows of narrow data (a key and a few numbers) that may be broadcast after they have been counted.
BROADCAST_ROWS = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_scratch: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``, removed when the application ends.

    The context's checkpoint folder, and on a local master a temporary one, stand in where the setting is absent.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = f"{shared_root(spark)}/llm-{app}"
        atexit.register(_remove, spark, _scratch[app])
    return _scratch[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may have gone before this hook runs
        pass


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back; cuts lineage and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are few enough; otherwise Spark shuffles the join."""
    return F.broadcast(df) if rows <= limit else df


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def carried(df: DataFrame, keep: tuple[str, ...], **columns: Column) -> DataFrame:
    """``columns``, and the kept columns under names of their own (``_keep0``, ...), so that no name of an operator meets theirs."""
    return df.select(*[named(c).alias(f"_keep{k}") for k, c in enumerate(keep)], *[c.alias(n) for n, c in columns.items()])


def restored(df: DataFrame, keep: tuple[str, ...], results: tuple[str, ...]) -> DataFrame:
    """The kept columns under their old names, and the results; a kept column named like a result gives way to it."""
    return df.select(*[F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep) if c not in results], *results)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does exactly that on pure ASCII, and is several times faster than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than space and U+0009 to U+000D, with A-Z in lower case.

    The methods of ``bytes`` touch ASCII only, which is what the definition asks for.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_codes(texts: pa.Array, *, lower: bool = True) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words of a column of texts (null: none): a code for each word in order, the distinct words by code, words per text.

    Words are as in ``words_of``, unless ``lower`` is off. Arrow splits and numbers them, so Python touches distinct words only.
    """
    # take() copies a slice into buffers of its own: ascii_lower misreads some arrays whose offsets do not start at 0
    column = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    flat = lists.flatten().dictionary_encode()
    codes, words = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    if "" in words:  # white space at either end of a text splits off an empty word
        real = codes != words.index("")
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        codes = codes[real]
    return codes, words, np.diff(ends, prepend=0)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def give_back_memory() -> None:
    """Returns freed memory to the system: Python workers live on between stages, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU allocator
        pass


def settle(spark: SparkSession) -> None:
    """Between steps on the driver: collects garbage, so that Spark's cleaner drops the broadcasts and shuffles of earlier steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    give_back_memory()


def text_runs(batches: Iterator[pa.RecordBatch], column: str, chars: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of bounded text (a single longer text is a run of its own)."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + chars, "right")))
            yield b.slice(at, stop - at)
            at = stop
