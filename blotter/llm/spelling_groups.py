"""Spelling variant grouping: words that differ by one letter, found by PartEnum signatures, and the form each one stands for.

A word's letter multiset is a binary vector: a coordinate for each letter and each number of its occurrence (the second "e" of "letter" is a coordinate
of its own). One letter inserted or deleted changes one coordinate, one replaced changes two, so words within one edit have vectors of Hamming distance at
most ``DISTANCE`` = 2. PartEnum deals the coordinates to ``FRACTIONS`` parts by a fixed hash and gives a signature for each choice of ``FRACTIONS - DISTANCE``
parts: the coordinates that the word has in these parts. Two differing coordinates lie in at most two parts, so two such words share a signature, exactly.

Words made of the same syllables are anagrams by the thousand, with equal multisets and thus equal signatures. So a signature also carries what one
edit leaves alone: with m the length of the shorter word, the words agree in their first or in their last (m - 1) // 2 letters. A word gives its signatures with both
ends, for m its own length and one less, and only words that may be one edit apart meet. The signatures are equi-joined, and each pair is verified by its edit distance.

A word's ``form`` is the near word of largest count, if that is ``RATIO`` times its own or more; ``root`` is the last form reached from it. Counts grow
``RATIO`` times with each step, so a chain ends after log(total) steps; forms of forms are looked up by doubling, in a logarithm of that many joins.

Defined results: null and empty texts have no words. A null id reads as no characters (its runs hash as ``:<run>``). Repeated rows count as often as they
occur. Only the id and the text are read. Without words the result is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.shared import kept

LEAST_LENGTH, LEAST_COUNT, RATIO, SLIP = 6, 5, 5, 199
DISTANCE, FRACTIONS = 2, 4
#: Code points of one text read at a time, and different words that a task holds before it hands on their counts.
PIECE, HELD = 1 << 20, 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_OUTSIDE = re.compile("[^A-Za-zÀ-ÿ]")
_FOLD = {c: c + 32 for c in range(65, 91)}


def _run_counts(text: str) -> Counter:
    """How often each run, with A-Z lowered, occurs in a text; it is read in pieces that end outside runs."""
    out: Counter = Counter()
    lo = 0
    while lo < len(text):
        cut = _OUTSIDE.search(text, lo + PIECE) if len(text) - lo > PIECE else None
        hi = cut.start() if cut else len(text)
        out.update(_RUN.findall(text[lo:hi].translate(_FOLD)))
        lo = hi
    return out


def _count_words(least: int, slip: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                start = zlib.crc32(f"{i.as_py() if i.is_valid else ''}:".encode())
                for word, n in _run_counts(t.as_py() or "").items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        held[word] += n
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    return run


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the different words of all texts and their number of occurrences.

    Of each document's runs, those whose hash with its id divides by ``slip`` lose a letter.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = rows.mapInArrow(_count_words(least_length, slip), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def part_of(letter: str, place: int, fractions: int = FRACTIONS) -> int:
    """The part that a coordinate is dealt to."""
    return (ord(letter) * 2654435761 + place * 40503 >> 7) % 65521 % fractions


def signatures(word: str, least: int = LEAST_LENGTH, fractions: int = FRACTIONS, distance: int = DISTANCE) -> list[bytes]:
    """The PartEnum signatures of a word's letter multiset, each with one end of the word, for partners of equal and of other length."""
    parts: list[list[str]] = [[] for _ in range(fractions)]
    last, place = "", 0
    for c in sorted(word):
        place = place + 1 if c == last else 0
        last = c
        parts[part_of(c, place, fractions)].append(f"{c}{place}")
    chosen = ["".join([f"{k}:", *parts_of]) for k, parts_of in
              ((k, [x for p in pick for x in parts[p]]) for k, pick in enumerate(combinations(range(fractions), fractions - distance)))]
    size = len(word)
    ends = []
    for m in (size, size - 1):
        if m >= least:
            half = (m - 1) // 2
            ends += [f"{m}<{word[:half]}", f"{m}>{word[size - half:]}"]
    return [f"{s} {e}".encode() for s in chosen for e in ends]


def _sign(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                keys, at = [], []
                for k, w in enumerate(part.column(0).to_pylist()):
                    got = [zlib.crc32(s) << 32 | zlib.adler32(s) for s in signatures(w, least)]
                    keys += got
                    at += [k] * len(got)
                rows = pa.array(at, pa.int64())
                key = pa.array(np.array(keys, np.uint64).view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([key, part.column(0).take(rows), part.column(1).take(rows)], names=["key", "word", "n"])

    return run


def near_pairs(vocabulary: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(a, a_n, b, b_n): the pairs of words that one inserted, deleted or replaced code point takes into each other, each once, a < b.

    ``vocabulary`` is a stored frame of different words with their counts. Signatures meet by their hash; the edit distance decides.
    """
    signed = kept(vocabulary.select("word", "n").mapInArrow(_sign(least_length), "key long, word string, n long"))
    a = signed.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = signed.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
    return a.hint("merge").join(b, "key").where(close).select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain of forms, which must have no circle. Each join doubles the steps made."""
    reached = kept(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = kept(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = step.select("word", "root")
        if not step.where("moved").limit(1).collect():
            return reached


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                    ratio: int = RATIO, slip: int = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each different word of all texts."""
    vocabulary = kept(words(docs, id_col, text_col, least_length, least_count, slip))
    pairs = kept(near_pairs(vocabulary, least_length))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m")))
    top = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    top = top.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("m"))
    found = vocabulary.join(top, "word", "left")
    is_form = F.col("m") >= ratio * F.col("n")
    found = kept(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("other")).alias("form"), F.when(is_form, F.col("m")).alias("form_n")))
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
