"""Token counts: batch encoding inside Arrow functions that hand back lengths only.

Texts go to the tokenizer in batches of about equal bytes; a text longer than ``split_bytes`` is cut at places where no
token of the model can cross, so that one very long text neither fills the memory nor holds up its batch.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each; an empty table gives no rows. Of other columns only those
to ``keep`` are read, so they may have any names. A long text without a safe place stands whole in a call of its own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, slices, text_of

#: A space between ASCII letters or a letter and common punctuation: token boundaries in byte-level and word-end vocabularies.
SAFE = re.compile(r"(?<=[A-Za-z0-9.,;:!?])\x20(?=[A-Za-z])")
#: Byte-level vocabularies with their usual pattern also begin a word at a single space or line end behind no white space, and at a letter
#: behind the punctuation of scripts that are written without spaces.
SAFE_BYTES = re.compile(r"(?<=\S)(?=\x20[^\W\d_])|(?<=\S)(?=\n)|(?<=[。！？；：，、])(?=[^\W\d_])")


def cut(text: str, most: int, safe: re.Pattern = SAFE, drop_space: bool = False) -> list[str]:
    """``text`` in parts of at least ``most`` characters, cut before a safe place (or around its space, if ``drop_space``)."""
    parts, begin = [], 0
    while len(text) - begin > most:
        found = safe.search(text, begin + most)
        if not found:
            break
        parts.append(text[begin : found.start()])
        begin = found.end() if drop_space else found.start()
    parts.append(text[begin:])
    return parts


class Counter:
    """Numbers of tokens by one tokenizer file; made once in each Python worker."""

    _made: dict[str, Counter] = {}

    def __init__(self, path: str) -> None:
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.lengths: Callable[[list[str]], list[int]] = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.splits, self.drop_space = True, False
            before, added = tokenizer.pre_tokenizer, tokenizer.get_added_tokens_decoder().values()
            usual = isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space and tokenizer.normalizer is None
            self.safe = SAFE_BYTES if usual and not any(t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added) else SAFE
        elif path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            pieces = (model.id_to_piece(k) for k in range(model.get_piece_size()))
            # A part gets the space before it back as the prefix that the model adds to each text.
            self.splits = model.encode("a", out_type=str)[0].startswith("▁") and not any("▁" in p.lstrip("▁") for p in pieces)
            self.drop_space, self.safe = True, SAFE
        else:
            raise ValueError(f"{path}: a tokenizer is a .json or a .model file")

    @classmethod
    def at(cls, path: str) -> Counter:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def count(self, texts: list[str], split_chars: int) -> list[int]:
        parts: list[str] = []
        owner: list[int] = []
        for k, text in enumerate(texts):
            own = cut(text, split_chars, self.safe, self.drop_space) if self.splits and len(text) > split_chars else [text]
            parts += own
            owner += [k] * len(own)
        totals = [0] * len(texts)
        for k, n in zip(owner, self.lengths(parts), strict=True):
            totals[k] += n
        return totals


def token_counts(df: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512, batch_bytes: int = 1 << 20, split_chars: int = 1 << 16) -> DataFrame:
    """``keep`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row's whole text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.at(tokenizer)
        for part, texts in slices(batches, part_index, batch_bytes):
            n = pa.array(counter.count(texts, split_chars), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:part_index], n], names=[*part.schema.names[:part_index], "n_tokens"])

    part_index = len(keep) + 1
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("__text"))
    schema = rows.drop("__text").schema.add("n_tokens", "long")
    return bounded_batches(rows).mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
