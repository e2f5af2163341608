"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search runs over the boundaries between a text's characters. Arcs are the vocabulary's pieces (single unknown characters go
to bytes or to the unknown id); for a unigram model the best path has the largest sum of scores. For a BPE model an arc may
follow another only if the merges, applied to the two pieces together, leave them apart; the path that obeys this
everywhere is the encoding, so the ids are the library's. Backpointers are kept for a window only: an arc is at most the
longest piece long, so all paths to come start at one of the window's last boundaries, and as soon as the backpointer paths
from these meet in one boundary, the ids before it are committed and forgotten.

No piece goes on into the next word, so paths always meet where a word ends, and all before it is committed there at the latest. What was
committed for a word, and for a run of letters in it, is remembered in a bounded memory per Python worker.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import id_and_text

#: Words and parts that a worker keeps in each of two generations (longer ones than LONG characters aren't kept), and judged pairs of pieces.
CACHE, LONG = 400_000, 64
PAIRS = 400_000
SPACE = "▁"


class Codec:
    """Encoder and decoder for one model file; only vocabulary, scores and normalisation come from the library."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        self.kind = kind
        self.scores, self.ids, self.bytes_, self.out = {}, {}, {}, []
        for i in range(size):
            piece = m.id_to_piece(i)
            if m.is_control(i) or m.is_unused(i) or m.is_unknown(i):
                self.out.append(b"" if not m.is_unknown(i) else " ⁇ ".encode())
            elif m.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            else:
                self.scores[piece], self.ids[piece] = m.get_score(i), i
                self.out.append(piece.replace(SPACE, " ").encode())
        self.unknown = m.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        #: finds the pieces that end at each character, longest first
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.singles = {p for p in self.ids if len(p) == 1}
        probe = " a  bé é Ａ\tc\n"
        self.plain = m.normalize(probe) == SPACE + probe.replace(" ", SPACE) and m.normalize("") == ""
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: word by word, if no piece goes on from a word into the next
        self.split = None if inner else regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.parts_of = regex.compile(f"{SPACE}*\\p{{L}}+|[^\\p{{L}}]+").findall
        self.words, self.parts, self.pairs = textops.Memo(CACHE), textops.Memo(CACHE), textops.Memo(PAIRS)

    # -- encoding

    def normalise(self, text: str) -> str:
        if not self.plain:
            return self.model.normalize(text)
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """The BPE merges of a short string: the neighbours whose union has the best score, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, a: str, b: str) -> bool:
        key = (a, b)
        got = self.pairs.new.get(key)
        if got is None:
            got = self.pairs.get(key)
        if got is None:
            got = self.merged(a + b) == [a, b]
            self.pairs.put(key, got)
        return got

    def _arcs(self, text: str) -> Iterator[tuple[int, str]]:
        """(end - 1, piece) of the arcs by rising end, longest first; a character that is no piece is an arc of its own."""
        if self.singles.issuperset(text):
            return self.automaton.iter(text) if len(self.automaton) else iter(())
        found = self.automaton.iter(text) if len(self.automaton) else ()
        alone = ((i, c) for i, c in enumerate(text) if c not in self.singles)
        return heapq.merge(found, alone, key=lambda arc: (arc[0], -len(arc[1])))

    def pieces(self, text: str) -> Iterator[str]:
        """The pieces of a normalised text, each as soon as it is settled. What the search holds is that of the window, not of the text."""
        base, end = 0, 0  # the boundary before which all is committed, and the last one looked at
        tail = {0: ""}  # boundary -> the last piece of its path, which is its backpointer
        total = {0: 0.0}
        bpe, scores, window = self.kind == "bpe", self.scores, 4 * self.longest
        judged = self.pairs.new
        for at, piece in self._arcs(text):
            if at >= end:
                if end - base >= window:
                    met = self._met(tail, base, end)
                    if met > base:
                        yield from self._path(tail, base, met)
                        tail = {k: v for k, v in tail.items() if k >= met}
                        if not bpe:  # scores count from the new base
                            zero = total[met]
                            total = {k: v - zero for k, v in total.items() if k >= met}
                        base = met
                end = at + 1
            if bpe and end in tail:  # a longer piece obeys the rule
                continue
            start = end - len(piece)
            before = tail.get(start)
            if before is None:  # not reached, or before all that is left of the text
                continue
            if bpe:
                if before:
                    ok = judged.get((before, piece))
                    if ok is None:
                        ok = self.may_follow(before, piece)
                    if not ok:
                        continue
                tail[end] = piece
            else:
                score = total[start] + scores.get(piece, -1e6)
                if end not in tail or score > total[end]:
                    tail[end], total[end] = piece, score
        yield from self._path(tail, base, len(text))  # one path is left at the end

    @staticmethod
    def _path(tail: dict, base: int, at: int) -> list[str]:
        """The pieces from ``base`` to ``at``, by the backpointers."""
        out = []
        while at > base:
            piece = tail[at]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    def _met(self, tail: dict, base: int, end: int) -> int:
        """The last boundary that the paths of all surviving boundaries share: arcs to come start among the window's last ones."""
        common: set[int] | None = None
        for k in range(max(base, end - self.longest + 1), end + 1):
            if k in tail:
                path = {k}
                while k > base:
                    k -= len(tail[k])
                    path.add(k)
                common = path if common is None else common & path
        return max(common or {base})

    def _settled(self, word: str) -> list[str]:
        """The pieces of a word, by the search. For a BPE model letters and other characters are searched apart, and what was committed is remembered; where the
        last piece of one part may be followed by the first of the next, the joined path obeys the rule everywhere, else the whole is searched."""
        if self.kind != "bpe":
            return list(self.pieces(word))
        out: list[str] = []
        for part in self.parts_of(word):
            got = self.parts.get(part)
            if got is None:
                got = list(self.pieces(part))
                if len(part) <= LONG:
                    self.parts.put(part, got)
            if out and not self.may_follow(out[-1], got[0]):
                return list(self.pieces(word))
            out += got
        return out

    def _word(self, word: str) -> bytes:
        out: list[int] = []
        for piece in self._settled(word):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes_:
                out += [self.bytes_[b] for b in piece.encode()]
            elif not (out and out[-1] == self.unknown):  # neighbouring unknown characters are one
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split is None or not self.plain:
            text = self.normalise(text)
            words = [text] if self.split is None else self.split(text)
            first = ""
        elif SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            words, first = self.split(self.normalise(text)), ""
        else:  # single blanks: every word has one before it
            words, first = text.split(" "), SPACE
        got = list(map(self.words.new.get, words)) if first else [None] * len(words)
        if None in got:
            found = {}
            for w in {w for w, g in zip(words, got) if g is None}:
                ids = self.words.get(w) if first else None
                if ids is None:
                    ids = self._word(first + w)
                    if first and len(w) <= LONG:
                        self.words.put(w, ids)
                found[w] = ids
            got = [found[w] if g is None else g for w, g in zip(words, got)]
        return b"".join(got)

    # -- decoding

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces and bytes one after another, without the blank that encoding puts first. Bytes that are no UTF-8
        become replacement characters. An id that the vocabulary lacks reads as the unknown id; bytes after the last whole id are left out."""
        known = np.frombuffer(ids[: len(ids) // 4 * 4], "<u4")
        known = np.where(known < len(self.out), known, self.unknown) if self.unknown >= 0 else known[known < len(self.out)]
        out = b"".join(map(self.out.__getitem__, known.tolist())).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def codec(path: str, kind: str = "bpe") -> Codec:
    cache = textops.worker_cache()
    if ("codec", path, kind) not in cache:
        cache["codec", path, kind] = Codec(path, kind)
    return cache["codec", path, kind]


def _encode_rows(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, kind)
        for b in batches:
            ids = [c.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe") -> DataFrame:
    """(doc_id, ids) of each row, ids as little-endian unsigned 32-bit integers. Null and empty texts have no ids."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_encode_rows(path, kind), "doc_id long, ids binary")


def _decode_rows(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, kind)
        for b in batches:
            texts = [None if x is None else c.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", kind: str = "bpe") -> DataFrame:
    """(doc_id, text) of each row of ids; null ids have a null text."""
    d = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{ids_col}`").cast("binary").alias("ids"))
    return d.mapInArrow(_decode_rows(path, kind), "doc_id long, text string")


def _digests(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, kind)
        names = ["doc_id", "n_ids", "ids_crc32", "n_bytes", "decoded_sha256", "round_trip"]
        for b in batches:
            out = {k: [] for k in names}
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = c.encode(text or "")
                back = c.decode(ids)
                raw = back.encode()
                row = (i, len(ids) // 4, zlib.crc32(ids), len(raw), hashlib.sha256(raw).hexdigest(), back == (text or "").replace(SPACE, " "))
                for k, v in zip(names, row):
                    out[k].append(v)
            kinds = {"decoded_sha256": pa.string(), "round_trip": pa.bool_()}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, kinds.get(k, pa.int64())) for k in names]))

    return run


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe") -> DataFrame:
    """(doc_id, n_ids, ids_crc32, n_bytes, decoded_sha256, round_trip) of each row: its ids and the text decoded from them, as digests.

    round_trip: whether the decoded text is the text (the model writes blanks as U+2581, so that character comes back as a blank).
    Null texts count as empty; ids may be null or repeat.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, n_bytes long, decoded_sha256 string, round_trip boolean"
    return id_and_text(docs, id_col, text_col).mapInArrow(_digests(path, kind), schema)
