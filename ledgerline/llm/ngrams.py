"""N-grams of texts as 64-bit keys, in numpy (for Arrow tasks).

A word is the hash of its bytes and its text's language; a pair and a triple are ``xxhash64`` of their words as Spark
computes it.  The marks before and after a text are no words: a text that holds the same characters has another hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4_000_000  # of text, in one step of a task
LONG = 128  # bytes of a word, beyond which it is hashed by itself
SEED = np.uint64(42)


def _p(x: int) -> np.uint64:
    return np.uint64(x)


P1, P2, P3 = _p(0x9E3779B185EBCA87), _p(0xC2B2AE3D27D4EB4F), _p(0x165667B19E3779F9)
P4, P5 = _p(0x85EBCA77C2B2AE63), _p(0x27D4EB2F165667C5)


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _p(n)) | (x >> _p(64 - n))


def xxhash(values: np.ndarray, seed) -> np.ndarray:
    """Spark's ``xxhash64`` of a long column, ``seed`` being the hash of the columns before it."""
    with np.errstate(over="ignore"):
        h = (seed + (P5 + _p(8))) ^ (_rotated(values * P2, 31) * P1)
        h = _rotated(h, 27) * P1 + P4
        h = (h ^ (h >> _p(33))) * P2
        h = (h ^ (h >> _p(29))) * P3
        return h ^ (h >> _p(32))


def named(text: bytes | str | None, kind: bytes = b"") -> np.uint64:
    """64-bit hash of one string; null has its own."""
    raw = b"" if text is None else text.encode() if isinstance(text, str) else text
    return np.frombuffer(hashlib.blake2b(raw, digest_size=8, person=b"null" if text is None else kind).digest(), "<u8")[0]


START, END = named("start", b"mark"), named("end", b"mark")


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of a binary array without nulls: length and eight bytes after eight bytes; of long words, by themselves."""
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    begin, size = ends[:-1], np.diff(ends)
    data = np.frombuffer(bytes(words.buffers()[2] or b"")[:ends[-1]] + bytes(8), np.uint8)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = xxhash(size.astype(np.uint64), SEED)
    at = np.arange(len(words))
    for k in range(0, LONG, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        over = np.maximum(k + 8 - size[at], 0).astype(np.uint64) * _p(8)
        h[at] = xxhash((eight[begin[at] + k] << over) >> over, h[at])
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = named(words[i].as_py(), b"long")
    return h


def marked(words: pa.Array, n: np.ndarray, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of two opening marks, the words and a closing mark of every text; where texts begin; the hashes of their languages."""
    coded = words.cast(pa.binary()).dictionary_encode()
    own = hashed(coded.dictionary)
    spoken = langs.dictionary_encode(null_encoding="encode")
    kinds = np.array([named(x, b"lang") for x in spoken.dictionary.to_pylist()], np.uint64)
    kinds = kinds[spoken.indices.to_numpy(zero_copy_only=False)]
    first = np.concatenate([[0], np.cumsum(n + 3)])
    x = np.empty(first[-1], np.uint64)
    inner = np.ones(first[-1], bool)
    for at, mark in ((first[:-1], START), (first[:-1] + 1, START), (first[1:] - 1, END)):
        x[at] = mark
        inner[at] = False
    x[inner] = own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else own
    return xxhash(x, np.repeat(kinds, n + 3)), first, kinds


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array (runs of bytes other than ASCII spaces), and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, n = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full).as_py():
        kept = full.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(kept)])
        ends = np.cumsum(n)
        n = before[ends] - before[ends - n]
        words = words.filter(full)
    return words, n


def chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` in sum."""
    group = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from ((a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def stored(*arrays: np.ndarray) -> bytes:
    """64-bit arrays as compressed bytes: the lowest bytes of all values, then the next, so that like bytes lie together."""
    out = [np.array([len(arrays)], "<i8").tobytes()]
    for x in arrays:
        raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()
        small = pa.compress(raw, "zstd", asbytes=True) if raw else b""
        out += [np.array([len(x), len(small)], "<i8").tobytes(), small]
    return b"".join(out)


def read(blob, kind: str = "<i8") -> list[np.ndarray]:
    """The arrays of ``stored``."""
    blob, at, out = memoryview(blob), 8, []
    for _ in range(np.frombuffer(blob[:8], "<i8")[0]):
        n, size = np.frombuffer(blob[at:at + 16], "<i8").tolist()
        at += 16
        raw = pa.decompress(pa.py_buffer(blob[at:at + size]), n * 8, "zstd", asbytes=True) if n else b""
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(kind).ravel())
        at += size
    return out


def mod(keys: np.ndarray, n: int) -> np.ndarray:
    """Spark's ``pmod`` of keys as longs."""
    return np.mod(keys.view(np.int64), n)


def starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows begins."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = False
    for x in sorted_columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = starts(keys)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def place(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in sorted ``known``, and whether it does."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys
