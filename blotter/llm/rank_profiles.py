"""Language identification by rank-order profiles.

A profile is the list of the ``TOP`` most frequent n-grams, in order of their frequency (ties: shorter n-grams first, then code-point
order). N-grams are the one to three letters in a row of a text's lower-cased words, each word with a blank on both sides. A document goes to the
language whose profile is nearest by out-of-place distance: the sum over the document's profile of the difference of an n-gram's two ranks, and ``TOP``
for an n-gram that the language's profile lacks. Ties go to the smaller name.

Profiles of languages count all training documents: n-grams are counted per block of texts in Python workers and summed by one aggregate.
Three code points of 21 bits fit a long, so n-grams are exact integers, not hashes. The driver holds ``TOP`` integers per language.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0, and so is every text where no language
was learned. Rows with a null id or a null language aren't learned from (but predicted). Repeated rows count as often as they
occur, and are predicted each. The score is 1 less the distance as a share of the largest one (no n-gram in common), so 0 to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm import textops

TOP = 300
BITS = 21
#: Code points of one text that are handled at a time, and n-grams that a task holds before it hands on their counts.
PIECE, HELD = 1 << 20, 1 << 22
#: Parts in which a language's n-grams are ranked before its first TOP are ranked together.
BUCKETS = 64
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]")


def _letters() -> np.ndarray:
    """For each code point whether it is a letter; made once in a worker."""
    cache = textops.worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return cache["letters"]


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE code points that end outside words."""
    lo = 0
    while len(text) - lo > PIECE:
        cut = _NO_LETTER.search(text, lo + PIECE)
        if cut is None:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:] if lo else text


def grams(piece: str) -> np.ndarray:
    """The n-grams of a piece of text, as integers."""
    c = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the blank that ends a word
    a = np.concatenate([[32], np.where(letter, c, 32)[keep], [32]]).astype(np.int64)
    if len(a) == 2 or not letter.any():
        return np.zeros(0, np.int64)
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]
    two = a[:-1] << BITS | a[1:]
    three = (two[:-1] << BITS | a[2:])[a[1:-1] != 32]
    return np.concatenate([a[a != 32], two, three])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counted n-grams of several parts as one list, each n-gram once."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    g, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.zeros(len(g), np.int64)
    np.add.at(n, where, np.concatenate([p[1] for p in parts]))
    return g, n


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A whole text's different n-grams in ascending order, and how often each occurs."""
    return _merged([np.unique(grams(p), return_counts=True) for p in _pieces(text)])


def ranked(g: np.ndarray, n: np.ndarray, top: int = TOP) -> np.ndarray:
    """The profile: the most frequent n-grams first. Fewer code points make smaller integers, so ties go to shorter n-grams."""
    return g[np.lexsort((g, -n))[:top]]


def _count_block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counted n-grams of several texts together."""
    whole = [p for t in texts for p in _pieces(t)]
    out, held, size = [], [], 0
    for p in whole:
        held.append(grams(p))
        size += len(held[-1])
        if size >= HELD:
            out.append(np.unique(np.concatenate(held), return_counts=True))
            held, size = [], 0
    if held:
        out.append(np.unique(np.concatenate(held), return_counts=True))
    return _merged(out)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the texts of each language, summed per block of about a megabyte and then per HELD n-grams."""
    sums: dict[str, list] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in sums.items():
            g, n = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])
        sums.clear()

    for b in batches:
        _, off = textops.byte_view(b.column(1))
        for i, j in textops.blocks(off):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).slice(i, j - i).to_pylist(), b.column(1).slice(i, j - i).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                part = _count_block(texts)
                sums.setdefault(lang, []).append(part)
                held += len(part[0])
        if held >= HELD:
            yield from flush()
            held = 0
    yield from flush()


def held_out(id_column):
    """Whether a row is kept from learning: crc32 of its id, as text, leaves 1 when divided by 3."""
    return F.crc32(id_column.cast("string").cast("binary")) % 3 == 1


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> dict[str, list[int]]:
    """The ranked n-grams of each language, from all rows that aren't held out and have a language."""
    df = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    df = df.where("id is not null and lang is not null and text is not null").where(~held_out(F.col("id")))
    sums = df.select("lang", "text").mapInArrow(_count_rows, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # first per language and bucket, then per language: no task meets more than BUCKETS * top n-grams of a language at the end
    sums = sums.withColumn("bucket", F.pmod("gram", F.lit(BUCKETS)))
    for keys in (["lang", "bucket"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), "gram"))
        sums = sums.withColumn("place", place).where(F.col("place") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in sums.select("lang", "place", "gram").collect():
        found.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {k: [g for _, g in sorted(v)] for k, v in found.items()}


class Ranks:
    """Profiles as one table: for each n-gram of any profile its rank in each language, ``top`` where a language lacks it."""

    def __init__(self, found: dict[str, list[int]], top: int = TOP):
        self.names, self.top = sorted(found), top
        self.grams = np.unique(np.concatenate([np.array(found[k], np.int64) for k in self.names] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)  # the last row: in no profile
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, found[name]), k] = np.arange(len(found[name]))

    def distances(self, profile: np.ndarray) -> np.ndarray:
        """The out-of-place distance of a document's profile to each language."""
        at = np.searchsorted(self.grams, profile)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != profile] = len(self.grams)
        rank = self.ranks[at]
        return np.where(rank < 0, self.top, np.abs(rank - np.arange(len(profile))[:, None])).sum(0)

    def predict(self, text: str | None) -> tuple[str, float]:
        profile = ranked(*counted(text or ""), self.top)
        if not len(profile) or not self.names:
            return UNKNOWN, 0.0
        d = self.distances(profile)
        k = int(d.argmin())
        return self.names[k], 1 - int(d[k]) / (self.top * len(profile))


def _predict_rows(found: dict[str, list[int]], top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(found, top)
        for b in batches:
            got = [ranks.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return run


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row; only the text is an input of a prediction."""
    found = profiles(docs, id_col, text_col, lang_col, top)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(_predict_rows(found, top), f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
