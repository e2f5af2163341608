"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle of pre-tokens.

Tier 1: a compact table of the most frequent pre-tokens and their numbers of tokens, broadcast to all tasks. Tier 2: a
cache per Python worker; what it misses is encoded once by the tokenizer's own model. The number of tokens of a text is
the sum over its pre-tokens, as merges never cross them.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import id_and_text

#: Pre-tokens in the broadcast table, and in the summary that a scan task sends of its part.
TABLE, SUMMARY = 1 << 15, 1 << 12
#: Pre-tokens in each of the two generations of a worker's cache; longer ones than LONG characters aren't kept.
CACHE, LONG = 1 << 18, 64

#: Fixed value: the published split pattern of byte-level BPE tokenizers (white space written out).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Stretches of these characters are split here; others by the library, whose Unicode tables may be of another version.
PLAIN = r"[\x00-\x1b\x20-ɏͰ-ϿЀ-ӿ‐-‧‰-⁞€]*"


def byte_alphabet() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable ones stand for themselves, the rest follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Splitter:
    """Splits texts into pre-tokens and counts a pre-token's tokens, as the library does for this tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        #: only plain byte-level tokenizers have the known split; any other file is counted by the library itself
        self.known = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        added = spec["added_tokens"]
        #: the longest special string that starts at a place counts, as in the library; ones that need more than their characters are left to it
        self.known = self.known and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        #: white space before characters that are none; no pre-token goes on from a character that is none into white space
        self.stretches = regex.compile(r"\p{White_Space}*\P{White_Space}+|\p{White_Space}+").findall
        self.find = regex.compile(SPLIT).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.alphabet = byte_alphabet()

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens to look up, and the number of tokens of all else: special strings, and stretches that the library counts."""
        if not self.known:
            return [], self.whole(text)
        if not (self.special and self.special.search(text)):
            return self._plain_pieces(text)
        runs = self.special.split(text)
        found, n = [], len(runs) - 1
        for run in runs:
            got, k = self._plain_pieces(run)
            found += got
            n += k
        return found, n

    def _plain_pieces(self, text: str) -> tuple[list[str], int]:
        if self.plain(text):
            return self.find(text), 0
        found, n = [], 0
        for stretch in self.stretches(text):
            if self.plain(stretch):
                found += self.find(stretch)
            else:
                n += self.whole(stretch)
        return found, n

    def length(self, piece: str) -> int:
        alphabet = self.alphabet
        return len(self.tokenizer.model.tokenize("".join([alphabet[b] for b in piece.encode()])))

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _splitter(path: str) -> Splitter:
    cache = textops.worker_cache()
    if ("splitter", path) not in cache:
        cache["splitter", path] = Splitter(path)
        cache["lengths", path] = textops.Memo(CACHE)
    return cache["splitter", path]


def _frequent(path: str, summary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(path)
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update(split.pieces(text or "")[0])
                if len(counts) > 64 * summary:  # a bounded summary: the rarest go
                    counts = Counter(dict(counts.most_common(16 * summary)))
        top = [(k, v) for k, v in counts.most_common(summary) if len(k) <= LONG and v > 1]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], names=["piece", "c"])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", size: int = TABLE, summary: int = SUMMARY) -> dict[str, int]:
    """Numbers of tokens of the (at most ``size``) most frequent pre-tokens of all texts.

    Each scan task sends its ``summary`` most frequent ones, so what is shuffled and collected is bounded by a constant per
    task. The table only saves work: a pre-token that it lacks is counted by the worker that meets it.
    """
    found = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(_frequent(path, summary), "piece string, c long")
    top = found.groupBy("piece").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "piece").limit(size).collect()
    split = Splitter(path)
    return {r["piece"]: split.length(r["piece"]) for r in top}


def _count(path: str, limit: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, frequent = _splitter(path), table.value
        seen = textops.worker_cache()["lengths", path]
        for b in batches:
            n_bytes, n_tokens = [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                pieces, n = split.pieces(text)
                got = list(map(frequent.get, pieces))
                if None in got:
                    for k, piece in zip(got, pieces):
                        if k is None:
                            k = seen.new.get(piece)
                            if k is None:
                                k = seen.get(piece)
                            if k is None:
                                k = split.length(piece)
                                if len(piece) <= LONG:
                                    seen.put(piece, k)
                        n += k
                else:
                    n += sum(got)
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, size: int = TABLE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, in one pass without a shuffle after the table is made.

    Null texts count as empty: 0 bytes, 0 tokens. Strings of special tokens inside a text are one token each, as the
    library's default has it. Ids may be null or repeat. Long texts are counted whole.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col, size))
    d = id_and_text(docs, id_col, text_col)
    return d.mapInArrow(_count(path, limit, table), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
