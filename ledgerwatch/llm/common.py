"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 1024  # rows of text that a task holds in worked-out form
BYTES_AT_ONCE = 2 << 20  # and their bytes, unless one row alone has more


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE, size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of bounded rows and bytes, so texts are worked on a few at a time."""

    most = BYTES_AT_ONCE if size is None else size

    def halves(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if part.num_rows < 2 or part.nbytes <= most:
            yield part
        else:
            yield from halves(part.slice(0, part.num_rows // 2))
            yield from halves(part.slice(part.num_rows // 2))

    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            for part in halves(batch.slice(start, rows)):
                # a copy: some of Arrow's string functions misread arrays that begin at an offset
                yield part.take(pa.array(np.arange(part.num_rows)))


def gathered(pieces: list[bytes], chosen: np.ndarray, bounds: np.ndarray, width: int = 1) -> pa.Array:
    """Byte strings, the i-th of them the pieces chosen[bounds[i]:bounds[i + 1]] put together.

    Pieces are multiples of `width` bytes long and are copied in units of that many.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // width
    units = np.frombuffer(b"".join(pieces), f"<u{width}")
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[chosen]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    source = np.repeat(starts[chosen] - (ends - lengths), lengths) + np.arange(total)
    offsets = np.concatenate([[0], ends])[bounds] * width
    return pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(units[source])]
    )


def cut_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and words of each text, cut at space and x09-x0D; null has none.

    The words of row i are words[offsets[i]:offsets[i + 1]].
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(text, "").cast(pa.large_string()))
    flat, bounds = lists.flatten(), np.asarray(lists.offsets)
    bounds = bounds - bounds[0]
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full, min_count=0).as_py():
        before = np.concatenate([[0], np.cumsum(np.asarray(full.to_numpy(zero_copy_only=False), dtype=np.int64))])
        flat, bounds = flat.filter(full), before[bounds]
    return bounds.astype(np.int64), flat


def words_of(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """As `cut_words`, with A-Z lower-cased."""
    return cut_words(pc.ascii_lower(text))


M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(32))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


LONG_WORD = 256  # bytes, from which words are hashed one by one


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process: that of pandas' `hash_array`."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = pc.dictionary_encode(words)
    values = coded.dictionary.cast(pa.large_binary())
    _, ends, data = values.buffers()
    bounds = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    sizes = np.diff(bounds)
    out = np.empty(len(values), np.uint64)
    short = np.flatnonzero(sizes < LONG_WORD)
    text = np.zeros(bounds[-1] - bounds[0] + 8, np.uint8)
    if data is not None:
        text[:-8] = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    out[short] = _sip_hashes(text, bounds[short] - bounds[0], sizes[short])
    long = np.flatnonzero(sizes >= LONG_WORD)
    if len(long):
        from pandas.util import hash_array

        out[long] = hash_array(np.asarray(coded.dictionary.take(pa.array(long)).to_pylist(), dtype=object), categorize=False)
    return out[np.asarray(coded.indices)]


def _sip_hashes(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SipHash-2-4 of byte strings in `text`, which goes on for eight bytes after them, and the mix that pandas puts on top."""
    key = np.frombuffer(b"0123456789123456", "<u8")
    blocks = sizes >> 3
    order = np.argsort(-blocks, kind="stable")  # those of many blocks first, so that each round is of a prefix
    starts, sizes, blocks = starts[order], sizes[order], blocks[order]
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
    v = [np.full(len(starts), k ^ np.uint64(c)) for k, c in zip((*key, *key), (0x736F6D6570736575, 0x646F72616E646F6D, 0x6C7967656E657261, 0x7465646279746573))]

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    def rounds(n: int, times: int) -> None:
        a, b, c, d = (x[:n] for x in v)
        for _ in range(times):
            a += b
            c += d
            b[:], d[:] = turned(b, 13) ^ a, turned(d, 16) ^ c
            a[:] = turned(a, 32)
            c += b
            a += d
            b[:], d[:] = turned(b, 17) ^ c, turned(d, 21) ^ a
            c[:] = turned(c, 32)

    for k in range(int(blocks.max(initial=0))):
        n = int(np.searchsorted(-blocks, -k))  # so many have a block k
        block = eight[starts[:n] + 8 * k]
        v[3][:n] ^= block
        rounds(n, 2)
        v[0][:n] ^= block
    rest = eight[starts + 8 * blocks] & ((np.uint64(1) << (8 * (sizes & 7)).astype(np.uint64)) - np.uint64(1))
    rest |= sizes.astype(np.uint64) << np.uint64(56)
    v[3] ^= rest
    rounds(len(starts), 2)
    v[0] ^= rest
    v[2] ^= np.uint64(0xFF)
    rounds(len(starts), 4)
    x = v[0] ^ v[1] ^ v[2] ^ v[3]
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    out = np.empty_like(x)
    out[order] = x ^ x >> np.uint64(31)
    return out


def shingle_hashes(bounds: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and hashes of the shingles of `width` words; fewer words are one shingle, none is none."""
    counts = np.diff(bounds)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    rows = np.repeat(np.arange(len(counts)), sizes)
    first = bounds[:-1][rows] + (np.arange(starts[-1]) - starts[:-1][rows])
    left = bounds[1:][rows] - first
    out = np.full(len(first), M2)
    for k in range(width):
        inside = k < left
        at = np.minimum(first + k, max(0, len(hashes) - 1))
        out = np.where(inside, mixed(out * M1 + hashes[at]) if len(hashes) else out, out)
    return starts, out


def deal(df: DataFrame, *cols: str) -> DataFrame:
    """The rows spread over the tasks of the session, whatever files they came from."""
    return df.repartition(*[F.col(c) for c in cols])
