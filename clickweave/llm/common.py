"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, mod: int) -> Column:
    """crc32 of the key as text, modulo `mod`; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def columns(frame: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so other columns cannot clash."""
    return frame.select(*[F.col(f"`{source}`").alias(name) for name, source in named.items()])


def kind(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, which cuts its lineage and outlives lost executors."""
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def pieces(texts: list[str], most_chars: int):
    """Slices of `texts` of about `most_chars` characters each; no text is cut."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most_chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one text after the other, and the texts' lengths."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), lengths


BATCH_ROWS = 2000


def importable(spark: SparkSession) -> SparkSession:
    """Readies a session for operators that run Python.

    Workers that share this machine's disk can import the package; a cluster ships it with --py-files. Arrow
    batches get at most `BATCH_ROWS` rows, which bounds a worker's memory also where texts are long.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


_PLACES = np.random.default_rng(20).integers(1, 1 << 63, (1024, 256), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> np.uint64(33)) * np.uint64(factor)
    return x ^ x >> np.uint64(33)


def hashed_words(split: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes (2 and more) of the words in lists of large strings, list after list, and each list's number of words.

    Empty words are left out.
    """
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary
    begin = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    size, begin, at = np.diff(begin), begin[:-1] - begin[0], begin[0]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[at : at + size.sum()] if size.sum() else np.zeros(0, np.uint8)
    place = np.arange(len(data)) - np.repeat(begin, size)
    total = np.zeros(len(words), dtype=np.uint64)
    if len(data):
        total[size > 0] = np.add.reduceat(_PLACES[place & 1023, data] * (2 * (place >> 10).astype(np.uint64) + np.uint64(1)), begin[size > 0])
    total = np.maximum((mixed(total) >> np.uint64(1)).astype(np.int64), 2)
    codes, owner = coded.indices.to_numpy(), np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    real = (size > 0)[codes] if len(codes) else np.zeros(0, dtype=bool)
    return total[codes[real]], np.bincount(owner[real], minlength=len(split))


def pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(packed: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def steps(values: np.ndarray) -> bytes:
    """Values in rising order, as the packed steps between them."""
    return pack(np.diff(values.astype(np.int64), prepend=0))


def sums(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.int64))


def plain_texts(texts: pa.Array) -> pa.Array:
    """Large strings without nulls in memory of their own: pyarrow's lower-casing misreads slices."""
    return pa.array(["" if text is None else text for text in texts.to_pylist()], pa.large_string())
