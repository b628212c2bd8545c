"""Pieces the operators share: table access, Arrow mapping, word splitting and hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.sources.staging import shared_folder

#: Bytes of text that one step inside a task holds at a time.
STEP_BYTES = 8 << 20
STEP_ROWS = 4096
#: Bits of the bitmap by which ``likely`` drops rows.
LIKELY_BITS = 1 << 26
_BLANK = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(column: str) -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and hand back a scan of it.

    This cuts lineage for iterative steps: a lost executor costs a re-read. The files belong to
    the application and are removed with its folder by whoever owns the shared storage.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among the wanted ones, and the few others that a bitmap lets through; no shuffle.

    The bitmap has LIKELY_BITS / 8 bytes in all, whatever the number of keys; null keys are dropped.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(LIKELY_BITS))
    wanted = wanted.select(F.col(key).cast(rows.schema[key].dataType).alias(key))
    bits = wanted.groupBy(F.floor(spot / 32768).alias("_part")).agg(
        F.bitmap_construct_agg((spot % 32768).cast("int")).alias("_bits")
    )
    byte = F.expr("conv(hex(substring(_bits, int(_spot % 32768) div 8 + 1, 1)), 16, 10)").cast("int")
    return (
        rows.where(F.col(key).isNotNull())
        .withColumn("_spot", spot)
        .withColumn("_part", F.floor(F.col("_spot") / 32768))
        .join(F.broadcast(bits), "_part")
        .where(byte.bitwiseAND(F.expr("shiftleft(1, int(_spot % 8))")) != 0)
        .select(*rows.columns)
    )


_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to Python workers that do not have it on their path already."""
    context, home = spark.sparkContext, os.path.dirname(_PACKAGE)
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if home in known or context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="gridmetrics-"), "gridmetrics.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(_PACKAGE):
            for name in (f for f in files if f.endswith(".py")):
                file = os.path.join(folder, name)
                archive.write(file, os.path.relpath(file, home))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_rows(
    df: DataFrame, schema: str, of: Callable[[list[dict]], Iterator[tuple]], size: str
) -> DataFrame:
    """Run ``of`` over steps of rows; a step ends when column ``size`` holds STEP_BYTES, or at
    ``STEP_ROWS`` rows.

    ``of`` gets a list of dicts and yields tuples in the order of ``schema``. Output is cut into
    batches of bounded length, so memory follows the step and not the partition.
    """
    ship(df.sparkSession)
    names, types = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        out = [[] for _ in names]
        for batch in batches:
            for rows in _steps(batch, size):
                for row in of(rows):
                    for column, value in zip(out, row):
                        column.append(value)
                    if len(out[0]) >= 20_000:
                        yield _batch(out, names, types)
                        out = [[] for _ in names]
        if out[0]:
            yield _batch(out, names, types)

    return df.mapInArrow(run, schema)


def map_columns(df: DataFrame, schema: str, of: Callable[[list[dict]], Iterator[tuple]], size: str) -> DataFrame:
    """Like ``map_rows``, but ``of`` yields columns (arrays, or None for nulls), several rows at a time."""
    ship(df.sparkSession)
    names, types = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        held, n = {}, 0
        for batch in batches:
            for rows in _steps(batch, size):
                for piece in of(rows):
                    # Pieces with nulls in the same columns are joined.
                    held.setdefault(tuple(c is None for c in piece), []).append(piece)
                    n += next(len(c) for c in piece if c is not None)
                    if n >= 50_000:
                        yield from joined(held.values())
                        held, n = {}, 0
        yield from joined(held.values())

    def joined(groups):
        for pieces in groups:
            columns = [None if c[0] is None else np.concatenate(c) for c in zip(*pieces)]
            n = next(len(c) for c in columns if c is not None)
            arrays = [
                pa.nulls(n, kind) if c is None else pa.array(c, type=kind, from_pandas=False)
                for c, kind in zip(columns, types)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> tuple[list[str], list[pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    parsed = StructType.fromDDL(schema)
    return parsed.names, [to_arrow_type(f.dataType) for f in parsed.fields]


def _batch(columns: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types)], names=names
    )


def _steps(batch: pa.RecordBatch, size: str) -> Iterator[list[dict]]:
    rows, held = [], 0
    column = batch.column(size)
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    lengths = np.diff(offsets[column.offset : column.offset + batch.num_rows + 1])
    start = 0
    for i, n in enumerate(lengths):
        held += int(n)
        if held >= STEP_BYTES or i + 1 - start >= STEP_ROWS:
            rows = batch.slice(start, i + 1 - start).to_pylist()
            start, held = i + 1, 0
            yield rows
    if start < batch.num_rows:
        yield batch.slice(start).to_pylist()


# ---------------------------------------------------------------------- words of bytes


def word_table(keep: bytes) -> bytes:
    """A ``bytes.translate`` table: A-Z lowered, ``keep`` and non-ASCII kept, the rest blank."""
    kept = set(keep) | set(range(128, 256))
    lower = {c: c + 32 for c in range(65, 91)}
    return bytes(lower.get(c, c) if lower.get(c, c) in kept else _BLANK for c in range(256))


#: Words of lower-case ASCII letters, digits and everything beyond ASCII.
ALNUM = word_table(b"0123456789abcdefghijklmnopqrstuvwxyz")
#: Words of anything but ASCII white space; A-Z lowered.
NON_SPACE = word_table(bytes(c for c in range(128) if c != 32 and not 9 <= c <= 13))

_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _PowerTables:
    up = _powers(int(_BASE), 1)
    down = _powers(1, 1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_PowerTables.up) < n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        size = max(n, 1 << 17)
        _PowerTables.up, _PowerTables.down = _powers(int(_BASE), size), _powers(inverse, size)
    return _PowerTables.up, _PowerTables.down


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of translated text (words are runs of non-blank bytes)."""
    word = np.empty(len(data) + 2, np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = np.frombuffer(data, np.uint8) != _BLANK
    edges = np.flatnonzero(np.diff(word))
    return edges[::2], edges[1::2]


def hash_words(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of translated text, in order, without a Python loop."""
    parts, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > STEP_BYTES:
            cut = data.find(b" ", at + STEP_BYTES)
            end = cut if cut >= 0 else end
        parts.append(_hash_words(data[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _hash_words(data: bytes) -> np.ndarray:
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[np.frombuffer(data, np.uint8)] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of the runs of ``size`` words; fewer words (but not none) make one run."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    out = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : n - width + 1 + j]
    return mix(out + np.uint64(width))


def hash_runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words (not fewer), as signed longs, at a cost that ``size`` does not change."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    up, down = _power_tables(len(words) + 1)
    sums = np.append(np.uint64(0), np.cumsum(words * up[: len(words)]))
    return signed(mix((sums[size:] - sums[:n]) * down[:n]))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)
