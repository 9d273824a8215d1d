"""Packing by power-of-two decomposition.

A document of n ids is split into as many pieces of ``longest`` ids as it holds and then one piece for each set bit of the
rest, longest first. Pieces of equal length share a bucket; a sequence is one piece, so no sequence crosses documents, each
is full, and training draws whole batches from one bucket. Work stays inside the scan's tasks: nothing is shuffled.

A null or empty text gives the end id alone, as one piece. Repeated rows and ids are packed each on its own; an empty table gives no rows.
Very long texts are encoded whole, in memory of their length. Of other columns only the key is read, so they may have any names.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from sys import byteorder

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, slices, text_of
from siltstone.llm.words import hold

#: How byte-level vocabularies cut texts into words before merging, with letters, numbers and white space listed for
#: the characters outside UNUSUAL, whose classes every library and Unicode version has alike.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ȳ–—‘-”…€]")
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ȳ", "0-9²³¹¼-¾", r"\t\n\r\x20"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


class Encoder:
    """Ids of a byte-level BPE file by the tokenizers library, remembering words: merges never cross the words of WORDS."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, most_words: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.words, self.most = Tokenizer.from_file(path), {}, most_words
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        cut = self.tokenizer.pre_tokenizer
        plain = isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space and self.tokenizer.normalizer is None and not getattr(self.tokenizer.model, "dropout", None)
        self.by_word = plain and byteorder == "little" and array("I").itemsize == 4

    @classmethod
    def at(cls, path: str, most_words: int = 1 << 19) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path, most_words)
        cls._made[path].most = most_words
        return cls._made[path]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.by_word or UNUSUAL.search(text) or self.special and self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        found, known = WORDS.findall(text), self.words
        new = list(set(found).difference(known))
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = list(set(found))
            for word, encoded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                known[word] = array("I", encoded.ids).tobytes()
        return b"".join(map(known.__getitem__, found))


def pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    whole = n // longest * longest
    out = [(k, longest) for k in range(0, whole, longest)]
    start, bit = whole, longest >> 1
    while start < n:
        if n & bit:
            out.append((start, bit))
            start += bit
        bit >>= 1
    return out


def pack(df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", longest: int = 1024, end_id: int = 0, most_words: int = 1 << 19) -> DataFrame:
    """One row per piece: key, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, bucket (log2 of length), sequence_id, offset.

    A worker remembers ``most_words`` words' ids (some 200 bytes each) and forgets all when there are more.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = int(end_id).to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer, most_words)
        hold(encoder.words)
        for part, texts in slices(batches, 1):
            row, start, length, ids, total = [], [], [], [], []
            for k, content in enumerate(texts):
                data = encoder.encode(content) + end
                n = len(data) // 4
                for a, m in pieces(n, longest):
                    row.append(k)
                    start.append(a)
                    length.append(m)
                    ids.append(data[4 * a : 4 * (a + m)])
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                names=[key, "start", "length", "ids", "doc_tokens"],
            )

    rows = df.select(F.col(f"`{key}`"), text_of(text).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    out = bounded_batches(rows).mapInArrow(packed, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long")
    # The scan gives the same rows in the same order when a task runs again, and so the same ids.
    return out.select("*", F.log2("length").cast("int").alias("bucket"), F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """A folder for each piece length, so that a trainer reads batches of equal length."""
    packed.write.partitionBy("bucket").parquet(path)
