"""Helpers shared by the operators: staged tables, text batches, hashed words.

The heavy operators work on Arrow batches inside Spark tasks.  A batch of texts becomes
one byte array with offsets, words and windows are hashed with prefix sums, and tasks
exchange *packed* rows: one row per (sender, receiver) that holds numpy arrays instead of
one row per token.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
import time
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from orderlake.session import ensure_checkpoint_dir

#: Bytes that separate words: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte -> byte with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Odd multiplier of the rolling hash, its inverse mod 2^64, and a random value per byte.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, np.uint64)


# --- staged tables ---------------------------------------------------------------------

def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


#: Settings while a staged table is written: a query's shuffle files go when it has ended, and record
#: batches of long texts stay small (both sides of the pipe hold them, next to the sort buffers).
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps re-read files, so a
    lost executor costs no recomputation, and the shuffle files of the write are not needed
    any more and go at its end."""
    spark = df.sparkSession
    path = scratch(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        writer.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(total_bytes: int, part_bytes: int, least: int = 4) -> int:
    """How many parts of at most about ``part_bytes`` hold ``total_bytes``."""
    return max(least, -(-total_bytes // part_bytes))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary value; integers in the smallest width that holds them."""
    return pickle.dumps([_narrow(a) for a in arrays], protocol=5)


def unpack(value) -> list[np.ndarray]:
    return pickle.loads(value)


def _narrow(a: np.ndarray) -> np.ndarray:
    if a.dtype.kind not in "iu" or a.dtype == np.uint64 or not len(a) or a.min() < 0:
        return a
    top = int(a.max())
    for kind in (np.uint8, np.uint16, np.uint32):
        if top <= np.iinfo(kind).max:
            return a.astype(kind)
    return a


# --- memory of the workers -------------------------------------------------------------

_HELD: dict[str, object] = {}
#: Seconds between two times that a worker gives memory back, and when it last did.
RELEASE_EVERY = 5.0
_RELEASED = [0.0]


def working(owner: str, drop=None) -> None:
    """Called where an operator begins in a Python worker, which Spark uses again for the next one: caches
    that other operators left are dropped.  ``drop`` empties the caches of ``owner``."""
    others = [o for o in _HELD if o != owner]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        release()
    if drop is not None:
        _HELD[owner] = drop


def release() -> None:
    """Give memory that is free back to the system, now and then; a worker otherwise keeps what it once grew to."""
    if time.monotonic() - _RELEASED[0] < RELEASE_EVERY:
        return
    _RELEASED[0] = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


# --- texts as bytes --------------------------------------------------------------------

def pieces(batches, column: str = "text", most: int = 4 << 20, owner: str = "texts"):
    """Cut record batches so that one piece holds at most ``most`` bytes of text, unless a
    single text is longer."""
    working(owner, _POWERS.clear if owner == "texts" else None)
    yield from _pieces(batches, column, most)
    if owner == "texts":
        release()


def _pieces(batches, column: str, most: int):
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string array; null is the empty text."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of the rolling hash; see ``span_hash``."""
    up, _ = _powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * up[:len(raw)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes anywhere."""
    _, down = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] ^ (end - start).astype(np.uint64))


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text): words are runs of bytes other than
    ``SPACE``, with A-Z lower-cased; words never cross texts."""
    raw = LOWER[raw]
    n = len(off) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    inside = ~SPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    begins = inside & (first[:-1] | np.concatenate(([True], ~inside[:-1])))
    ends = inside & (first[1:] | np.concatenate((~inside[1:], [True])))
    start = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(start, off))
    return span_hash(prefix_hash(raw), start, np.flatnonzero(ends) + 1), counts


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver imported it, if it is
    not on their path anyway (``--py-files`` or an installed package)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
