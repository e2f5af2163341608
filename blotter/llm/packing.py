"""Best-fit packing after a Martello-Toth dominance reduction.

Documents become token ids plus an end id; longer ones are cut into pieces of the sequence length. What is packed depends
on the lengths alone, so the instance is the histogram of lengths: at most ``capacity`` numbers, however many documents
there are. It is reduced and packed on the driver as patterns with multiplicities (see ``plan``), and each piece finds
its place from its rank among the pieces of its length. Ranks are counted per (length, bucket of ids) and shifted by the
counts of the buckets before, so no length, however common, is ordered in one task.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import id_and_text, kept
from blotter.llm.token_counts import byte_alphabet

CAPACITY, END_ID = 2048, 0
#: Parts that a worker keeps in each of two generations (and a quarter as many words); longer ones than LONG characters aren't kept.
CACHE, LONG = 250_000, 64
#: Pieces that a bucket of the ranking holds on average.
PER_BUCKET = 20_000


# ---------------------------------------------------------------- the plan


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix bins that provably belong to some best packing; takes them off ``counts``, returns (lengths, bins).

    For a length j with room R = capacity - j, a set of one or two others dominates every set that fits with j if the
    members of any such set can be exchanged for its own, each group for one at least as long. That holds for
    - j alone, if nothing else fits;
    - {i}, i the longest that fits, if i = R, or if no two others fit, or if no three fit and no two that fit
      together are longer than i;
    - {i, b}, b the longest that fits with j and i, if no three others fit and no two that are both longer than b fit
      together, unless i alone replaces them.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(*lengths: int) -> None:
        use = {x: lengths.count(x) for x in lengths}
        n = min(counts[x] // k for x, k in use.items())
        fixed.append((lengths, n))
        for x, k in use.items():
            counts[x] -= n * k
            if not counts[x]:
                del counts[x]

    changed = True
    while changed:
        changed = False
        for j in sorted(counts, reverse=True):
            while j in counts:
                room = capacity - j
                others = dict(counts)
                others[j] -= 1
                fits = sorted(x for x, k in others.items() if k and x <= room)
                if not fits:
                    fix(j)
                    changed = True
                    continue
                i = fits[-1]
                if i == room:
                    fix(j, i)
                    changed = True
                    continue
                low = [x for x in fits[:3] for _ in range(min(3, others[x]))][:3]
                if len(low) < 2 or low[0] + low[1] > room:
                    fix(j, i)
                    changed = True
                    continue
                if len(low) == 3 and sum(low) <= room:
                    break  # three fit: the criterion doesn't look further
                if _longest_pair(fits, others, room, 0) <= i:
                    fix(j, i)
                    changed = True
                    continue
                take = dict(others)
                take[i] -= 1
                second = [x for x in fits if take[x] and x <= room - i]
                if second and _longest_pair(fits, others, room, second[-1]) <= i:
                    fix(j, i, second[-1])
                    changed = True
                    continue
                break
    return fixed


def _longest_pair(fits: list[int], counts: dict[int, int], room: int, above: int) -> int:
    """The largest sum, at most ``room``, of two items that are both longer than ``above``; 0 if there is none."""
    best, lo, hi = 0, bisect.bisect_right(fits, above), len(fits) - 1
    while lo <= hi:
        both = fits[lo] + fits[hi]
        if both > room:
            hi -= 1
        else:
            if lo < hi or counts[fits[lo]] > 1:
                best = max(best, both)
            lo += 1
    return best


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(places, bins). A place (length, first bin, bins, offset, per bin) puts ``per bin`` items of a length, one after
    another from ``offset`` on, into each of the bins. The places of a length take its items in order.

    The reduction fixes bins first; the rest is packed by best fit, longest first, with equal bins handled together.
    """
    counts = {k: v for k, v in counts.items() if v > 0}
    places: list[tuple[int, int, int, int, int]] = []
    bins = 0
    for lengths, n in reduce_by_dominance(counts, capacity):
        offset = 0
        for x in lengths:
            places.append((x, bins, n, offset, 1))
            offset += x
        bins += n
    spare: dict[int, list[tuple[int, int]]] = {}  # room left -> (first bin, bins)
    rooms: list[int] = []

    def put_back(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in spare:
                spare[room] = []
                bisect.insort(rooms, room)
            spare[room].append((first, n))

    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            at = bisect.bisect_left(rooms, x)
            if at < len(rooms):
                room = rooms[at]
                first, n = spare[room].pop()
                if not spare[room]:
                    del spare[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, bins, -(-left // (capacity // x))
                bins += n
            each = room // x
            full = min(n, left // each)
            if full:
                places.append((x, first, full, capacity - room, each))
                put_back(room - each * x, first, full)
                left -= full * each
            if full < n and 0 < left < each:
                places.append((x, first + full, 1, capacity - room, left))
                put_back(room - left * x, first + full, 1)
                full, left = full + 1, 0
            put_back(room, first + full, n - full)
    return places, bins


# ---------------------------------------------------------------- token ids


#: What separates words of plain text, and the code points of a text that are split at a time.
BLANKS, TEXT_PIECE = " \t\n\r\x0b\x0c", 1 << 20


class WordEncoder:
    """Token ids of texts by a tokenizer for which white space only separates words, with a memory of parts.

    A text of plain characters is split into parts as the tokenizer splits it: parts seen before are looked up, others go to the tokenizer's own
    model. Of other texts, the plain words are encoded likewise and the rest by the library as they are; so are whole texts of a tokenizer of another kind.
    """

    #: Fixed value: the published split pattern of the word-end BPE tokenizers.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Characters whose lower case and composed form don't depend on their neighbours or on the Unicode version.
    PLAIN = r"!-~\u00a1-\u00ff\u2010-\u2027"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.parts = textops.Memo(CACHE // 4), textops.Memo(CACHE)
        probe = ["ab  ab\n\nab", "ab ab ab", " ab\tab ab "]
        one = self.raw(["ab"])[0]
        #: whether white space separates words and leaves no ids of its own; if not, whole texts are encoded
        self.by_word = all(x == 3 * one for x in self.raw(probe)) and self.raw([" \n "])[0] == b""
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        #: whether words may be split here: lower case, then the published pattern, then bytes
        self.known = self.by_word and steps[0].get("pattern") == {"Regex": self.SPLIT} and self.raw(["AB"]) == self.raw(["ab"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.known = self.known and all(x.startswith("<") for x in self.special)
        self.plain, self.plain_text = re.compile(f"[{self.PLAIN}]+").fullmatch, re.compile(f"[{self.PLAIN}{BLANKS}]*").fullmatch
        # the same pattern with the classes written out for plain characters, which Python's own matcher reads faster
        chars = [chr(c) for c in range(0x2028) if re.match(f"[{self.PLAIN}]", chr(c))]
        letters, digits = (re.escape("".join(c for c in chars if regex.match(kind, c))) for kind in (r"\p{L}", r"\p{N}"))
        pattern = self.SPLIT.replace(r"\p{L}", letters).replace(r"\p{N}", digits)
        self.split, self.alphabet = re.compile(pattern).findall, byte_alphabet()

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _marked(self, text: str) -> bool:
        """Whether a special token's string stands in the text."""
        return "<" in text and any(x in text for x in self.special)

    def _part(self, part: str) -> bytes:
        found = self.tokenizer.model.tokenize("".join([self.alphabet[x] for x in part.encode()]))
        return np.array([t.id for t in found], "<u4").tobytes()

    def _plain_ids(self, text: str) -> bytes:
        """Of plain characters and blanks."""
        parts = self.split(text.lower())
        got = list(map(self.parts.new.get, parts))
        if None in got:
            found = {}
            for p in {p for p, g in zip(parts, got) if g is None}:
                ids = self.parts.get(p)
                if ids is None:
                    ids = self._part(p)
                    if len(p) <= LONG:
                        self.parts.put(p, ids)
                found[p] = ids
            got = [found[p] if g is None else g for p, g in zip(parts, got)]
        return b"".join(got)

    def word(self, word: str) -> bytes:
        if not self.known or not self.plain(word) or self._marked(word):
            return self.raw([word])[0]
        return self._plain_ids(word)

    def _pieces(self, text: str) -> Iterator[str]:
        """A text in pieces of bounded size that end between words; a longer word comes whole."""
        lo = 0
        while len(text) - lo > TEXT_PIECE:
            cut = _BLANK.search(text, lo + TEXT_PIECE)
            if cut is None:
                break
            yield text[lo : cut.start()]
            lo = cut.start()
        yield text[lo:] if lo else text

    def _mixed_ids(self, text: str) -> bytes:
        """Word by word."""
        words = text.split()
        found = {}
        for w in set(words):
            ids = self.words.get(w)
            if ids is None:
                ids = self.word(w)
                if len(w) <= LONG:
                    self.words.put(w, ids)
            found[w] = ids
        return b"".join(map(found.__getitem__, words))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        for text in texts:
            # str.split() also splits at 0x1c to 0x1f, which the tokenizers take for symbols
            if not self.by_word or any(c in text for c in "\x1c\x1d\x1e\x1f"):
                yield self.raw([text])[0]
                continue
            plain = self.known and self.plain_text(text) and not self._marked(text)
            yield b"".join(map(self._plain_ids if plain else self._mixed_ids, self._pieces(text)))


_BLANK = re.compile(f"[{BLANKS}]")


def _encoder(path: str) -> WordEncoder:
    cache = textops.worker_cache()
    if ("words", path) not in cache:
        cache["words", path] = WordEncoder(path)
    return cache["words", path]


PIECES = "id long, piece int, start long, length long, crc long"


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("packing")
        encoder, end = _encoder(path), np.array([end_id], "<u4").tobytes()
        for b in batches:
            out = {k: [] for k in ("id", "piece", "start", "length", "crc")} | ({"ids": []} if with_ids else {})
            texts = [x or "" for x in b.column(1).to_pylist()]
            for i, ids in zip(b.column(0).to_pylist(), encoder.ids(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out["id"].append(i)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["crc"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            kinds = {"piece": pa.int32(), "ids": pa.binary()}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, kinds.get(k, pa.int64())) for k in out]))

    return run


def _place(places: list[tuple[int, int, int, int, int]]):
    """Sequence and offset of each piece, from its length and its rank (from 0) among those of its length."""
    table = np.array(places, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    size = table[:, 2] * table[:, 4]
    total = np.cumsum(size) - size
    first_row = np.searchsorted(table[:, 0], table[:, 0])
    start = total - total[first_row]  # the first rank of a place, within its length
    key = (table[:, 0] << 44) + start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("packing")
        for b in batches:
            col = {n: b.column(k) for k, n in enumerate(b.schema.names)}
            length, rank = (col[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            row = np.searchsorted(key, (length << 44) + rank, "right") - 1
            t = rank - start[row]
            _, first, n, offset, _ = table[row].T
            names = [k for k in b.schema.names if k != "rank"]
            yield pa.RecordBatch.from_arrays(
                [col[k] for k in names] + [pa.array(first + t % n), pa.array(offset + length * (t // n))], names=[*names, "sequence_id", "offset"]
            )

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece; with ``with_ids`` also its ids.

    Every document has at least one piece (a null or empty text is the end id alone). Pieces fill their sequences from 0 on
    without gaps. Rows may repeat and ids may be null: each row is packed.
    """
    d = id_and_text(docs, id_col, text_col)
    schema = PIECES + ", ids binary" * with_ids
    pieces = kept(d.mapInArrow(_pieces(path, capacity, end_id, with_ids), schema))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    places, _ = plan(counts, capacity)
    buckets = max(16, sum(counts.values()) // PER_BUCKET)
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "piece", "crc")
    ranked = keyed.withColumn("k", F.row_number().over(inside)).join(shift, ["length", "bucket"])
    cols = ["id", "piece", "start", "length", "crc", *["ids"] * with_ids]
    ranked = ranked.select(*cols, (F.col("k") - 1 + F.col("shift")).alias("rank"))
    out = ranked.mapInArrow(_place(places), schema + ", sequence_id long, offset long")
    return out.withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})
