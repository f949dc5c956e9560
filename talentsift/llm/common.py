"""Helpers shared by the operators: stored intermediate tables, byte-level words and a byte BPE encoder."""

from __future__ import annotations

import functools
import json
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from talentsift.session import shared_folder

#: While a step is stored: its shuffle files go when it ends, and Python workers get small batches of whole texts.
STEP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Split pattern of the public byte-level BPE vocabularies (fixed value).
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C55)


def stored(rows: DataFrame, purpose: str, conf: dict[str, str] | None = None) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back; ``conf`` holds while it is written.

    Later stages start from files that every executor can reach, so a lost
    executor costs its running tasks and not the work before them.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark, purpose)
    wanted = {**STEP_CONF, **(conf or {})}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        rows.write.parquet(folder)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(rows.schema).parquet(folder)


def forget(rows: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that a newer one replaces."""
    spark = rows.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the workers, once per application; the driver serves the archive."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(bodies: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``size`` bytes together; a longer text is a range of its own."""
    start, held = 0, 0
    for k, body in enumerate(bodies):
        held += len(body)
        if held >= size:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(bodies):
        yield start, len(bodies)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler, the same in every process."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * _MIX_1
        x = x ^ (x >> np.uint64(27))
        x = x * _MIX_2
        return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, _BASE, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the hash base, at least ``n`` of them."""
    return _powers(1 << max(10, int(n - 1).bit_length()))


@functools.lru_cache(maxsize=1)
def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in "0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
    table[128:] = True
    return table


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: runs of ASCII letters, digits, underscores and non-ASCII bytes."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _word_bytes()[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``h[i]`` hashes the first ``i`` bytes; see ``span_hash``."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[: len(data)], out=out[1:])
        return out


@functools.lru_cache(maxsize=4)
def _inverse_powers(n: int) -> np.ndarray:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        out = np.full(n, inverse, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, equal for equal bytes wherever they stand."""
    with np.errstate(over="ignore"):
        shift = _inverse_powers(1 << max(10, int(len(prefix)).bit_length()))
        raw = (prefix[ends] - prefix[starts]) * shift[starts]
        return mix64(raw + (ends - starts).astype(np.uint64) * _MIX_2)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` word hashes; fewer words than ``n`` make one shingle, none make none."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        size = min(n, len(words))
        out = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            out = mix64(out * _BASE + words[k : k + len(out)])
        return out


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Byte-level BPE ids of a ``tokenizers`` file, computed by the faster of the two engines.

    The vocabulary of such a file lists tokens in merge order, so its ids are
    ranks. Tests hold the ids against ``tokenizers`` itself. With
    ``special=True`` the string of a special token is one id, as the library
    does by default; otherwise it is ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        added = {token["content"]: token["id"] for token in content["added_tokens"] if token["special"]}
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in added}
        self.special = list(added) if special else []
        extra = added if special else {}
        self.engine = tiktoken.Encoding("byte_bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens=extra)

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.special):
            return self.engine.encode(text, allowed_special="all")
        return self.engine.encode_ordinary(text)


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str, special: bool = True) -> ByteBpe:
    """One encoder per worker process."""
    return ByteBpe(path, special)
