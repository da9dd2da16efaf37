"""Byte-level BPE encoding and decoding with the tokenizers library (operator 13).

Vocabulary.  A rank file lists byte strings by rank.  Every byte is written as
one printable character (``byte_table``), each token's last merge is found by
merging its bytes with the ranks below its own, and vocabulary, merges and split
pattern become one description of a ``tokenizers`` tokenizer.  It has the size of
the vocabulary file, is built once on the driver and travels with the tasks.

Encoding.  Arrow batches; a text is cut only before a single space between two
other characters, where the pattern always starts a new match, so the parts
have the ids of the whole.  Parts seen before come from a bounded cache.  Byte offsets
of the tokens are running sums of their lengths, because the bytes of the tokens are
the bytes of the text; ``char_offsets`` turns them into character offsets, where a
token that holds a piece of a character covers the whole of it.

Decoding.  The tokens' characters are turned back into bytes by the reversed
table, and the bytes of a row are joined before they are read as UTF-8, so
characters split over tokens come out whole; a character of which the ids hold
only a piece becomes U+FFFD in ``text`` and stays exact in ``bytes``.

Every row is coded by itself: nothing is shuffled, and a task holds one batch.

Defined results: null text counts as empty, and an empty text has no ids; null
ids decode to the empty string, and an id outside the vocabulary is an error;
special token strings are ordinary text; long texts are coded in parts; repeated
rows and null ids of documents are kept; an empty table gives an empty result;
columns that are not asked for are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tokens import WordIds

SLICE_CHARS = 4 << 20


def byte_table() -> list[str]:
    """A printable character for every byte: itself where printable in Latin-1, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that ranks below the token's own leave of its bytes; None if they leave more."""
    parts, own = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if rank >= own:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


@functools.lru_cache(maxsize=4)
def description(vocabulary: str | None = None) -> str:
    """The tokenizer of a rank file (by default ``byte_bpe_50k.tiktoken``) as the tokenizers library's JSON."""
    import public_tokenizers as public

    with open(vocabulary or public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    table = byte_table()
    spelled = {t: "".join(table[b] for b in t) for t in ranks}
    merges = [_last_merge(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    return json.dumps({
        "version": "1.0", "added_tokens": [], "normalizer": None, "post_processor": None, "decoder": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": public.PATTERN}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "model": {"type": "BPE", "ignore_merges": True, "vocab": {spelled[t]: r for t, r in ranks.items()},
                  "merges": [[spelled[a], spelled[b]] for a, b in filter(None, merges)]}})


class _Words:
    """What the word cache asks of an encoder."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode_ordinary(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def encoder(described: str) -> WordIds:
    """Cached word encoder of a description (one a Python worker)."""
    from tokenizers import Tokenizer

    return WordIds(_Words(Tokenizer.from_str(described)))


@functools.lru_cache(maxsize=2)
def token_bytes(described: str) -> pa.BinaryArray:
    """Bytes of every id, from the characters of its token and the reversed byte table."""
    back = {c: b for b, c in enumerate(byte_table())}
    vocab = json.loads(described)["model"]["vocab"]
    out: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for spelled, i in vocab.items():
        out[i] = bytes(back[c] for c in spelled)
    return pa.array(out, pa.binary())


def _sliced(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` in total; a larger row is a run of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row; ``offsets`` adds ``ends`` (the byte after each token) and ``char_starts, char_ends``."""
    described = description(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(described)
        lengths = pc.binary_length(token_bytes(described)).to_numpy() if offsets else None
        for whole in batches:
            sizes = np.array([len(t) for t in whole.column(1).cast(pa.binary()).fill_null(b"").to_pylist()], np.int64)
            for b in _sliced(whole, sizes, SLICE_CHARS):
                texts = b.column(1).fill_null("").to_pylist()
                ids = [np.frombuffer(words.encode(t), "<u4").astype(np.int32) for t in texts]
                columns = {"doc_id": b.column(0), "ids": _lists(ids)}
                if offsets:
                    ends = [np.cumsum(lengths[x]) for x in ids]
                    chars = [char_offsets(t.encode("utf-8", "surrogatepass"), e) for t, e in zip(texts, ends)]
                    columns |= {"ends": _lists(ends, pa.int64()), "char_starts": _lists([c[0] for c in chars], pa.int64()),
                                "char_ends": _lists([c[1] for c in chars], pa.int64())}
                yield pa.record_batch(list(columns.values()), names=list(columns))

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    more = ", ends array<bigint>, char_starts array<bigint>, char_ends array<bigint>" if offsets else ""
    return cols.mapInArrow(run, f"doc_id {cols.schema[0].dataType.simpleString()}, ids array<int>{more}")


def _lists(parts: list[np.ndarray], kind: pa.DataType = pa.int32()) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *parts]), kind))


def char_offsets(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one character of the tokens that end before the bytes ``ends``."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80  # bytes that begin a character
    begun = np.concatenate(([0], np.cumsum(first)))  # characters begun before each byte
    starts = np.concatenate(([0], ends))[:len(ends)]
    inside = starts < len(data)
    split = inside & ~np.append(first, True)[np.where(inside, starts, len(data))]
    return begun[starts] - split, begun[ends]


def decode(coded: DataFrame, vocabulary: str | None = None, ids_col: str = "ids", text: bool = True) -> DataFrame:
    """``coded`` without its ids, with ``bytes`` and (``text``) the same as a string."""
    described = description(vocabulary)
    keep = [c for c in coded.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(described)
        for whole in batches:
            sizes = whole.column(0).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for b in _sliced(whole, sizes, SLICE_CHARS):
                lists = b.column(0)
                flat = lists.flatten()  # leaves out what null rows cover
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                if flat.null_count or len(flat) and (flat.to_numpy().min() < 0 or flat.to_numpy().max() >= len(table)):
                    raise ValueError("an id outside the vocabulary")
                taken = table.take(flat)  # the tokens' bytes, one after the other
                if taken.null_count:
                    raise ValueError("an id outside the vocabulary")
                at = np.frombuffer(taken.buffers()[1], np.int32)[:len(taken) + 1] if len(flat) else np.zeros(1, np.int32)
                ends = np.ascontiguousarray(at[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32))
                data = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), taken.buffers()[2] or pa.py_buffer(b"")])
                columns = {f"c{i}": b.column(i) for i in range(1, b.num_columns)} | {"bytes": data}
                if text:
                    columns["text"] = pa.array([d.decode("utf-8", "replace") for d in data.to_pylist()], pa.string())
                yield pa.record_batch(list(columns.values()), names=list(columns))

    # columns travel under numbers, so that none of the caller's names can clash
    cols = coded.select(F.col(f"`{ids_col}`").cast("array<int>").alias("ids"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep, 1)])
    schema = ", ".join([f"c{i} {coded.schema[c].dataType.simpleString()}" for i, c in enumerate(keep, 1)] + ["bytes binary"] + ["text string"] * text)
    out = cols.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep, 1)], "bytes", *["text"] * text)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document's number of ids, and the hashes of its ids and of the bytes they decode to."""
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), "ids")
    return decode(coded, text=False).select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
