"""Suffix-array dedup by a depth-limited radix sort.

Suffixes are ordered only through ``depth`` bytes, by most-significant-digit passes; equal groups at that depth are the
repeated windows. A window that starts earlier too (smaller id, or same document and smaller start) is removed.

Digit 1 is a 32-byte string. Sorting every suffix by it would move many times the input, so only the suffixes at
*anchors* are sorted: the anchor of a window is the position, inside it, of the 32-byte string with the smallest hash
(leftmost of equals). It depends on the window's bytes alone, so equal windows have anchors with equal digits at
equal places, and each anchor serves one run of window starts, its cell. The passes:

1. Cells are dealt out and sorted by the digit and by all the bytes their windows cover. All but the first of equal cells
   are repeats from end to end. A task sends the first of equal cells only and settles the others itself, so a passage that
   a third of all documents share is a row per task, not per document.
2. Different cells of each digit are counted. A digit with one cell is finished, as none of its windows is repeated elsewhere.
3. In the others, the windows of each first cell are sorted by the remaining bytes, through the threshold, to find those
   that other cells hold too. This touches borders of repeats only. Only equal windows must meet: those of a digit that
   many different cells have, as at the edges of a common passage, are dealt to many parts by their hashes.

Digits, cells and windows are compared by 64-bit hashes within a group that already shares 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import BROADCAST_ROWS, id_and_text, id_filter, kept, may_hold

DEPTH, DIGIT = 100, 32
LOWEST = -(2**63)  # stands for an id of null, which comes first
ROW = np.dtype([("digit", "<i8"), ("cell", "<i8"), ("id", "<i8"), ("start", "<i8"), ("run", "<i8")])
PART_ROW = np.dtype([*ROW.descr, ("part", "<i8")])
#: Windows of a digit are dealt by their hashes to a part for each so many different cells, so no task gets a hot digit whole.
CELLS = 64


def _windowed_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    size, m = 1, v
    while size * 2 <= w:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def cells(data: np.ndarray, off: np.ndarray, depth: int, digit: int):
    """(document, digit hash, cell hash, first window start, number of window starts) of each cell of a block."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < depth:
        return none, none, none, none, none
    h, inverse = textops.prefix_hash(data, 101)
    k = textops.mix64((h[digit:] - h[:-digit]) * inverse[: n - digit + 1])
    low = np.uint64((1 << 24) - 1)
    anchors = []
    step = (1 << 24) - 4 * depth  # positions fit the 24 low bits
    for lo in range(0, n - depth + 1, step):
        part = k[lo : lo + step + depth - digit]
        m = _windowed_min((part & ~low) | np.arange(len(part), dtype=np.uint64), depth - digit + 1)[:step]
        anchors.append((m & low).astype(np.int64) + lo)
    anchor = np.concatenate(anchors)  # of the window that starts at each byte
    doc = np.searchsorted(off, np.arange(len(anchor)), "right") - 1
    inside = np.arange(len(anchor)) + depth <= off[doc + 1]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = at[new]
    run = np.diff(np.append(np.flatnonzero(new), len(at)))
    end = first + run - 1 + depth
    h2, inverse2 = textops.prefix_hash(data, 202)
    cell = textops.mix64((h2[end] - h2[first]) * inverse2[first] + run.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return doc[first], k[anchor[first]].view(np.int64), cell.view(np.int64), first - off[doc[first]], run


def _spans(rows: np.ndarray, depth: int) -> pa.RecordBatch:
    """Cells that are removed from end to end, as merged spans of bytes: rows of kind 0."""
    rows = rows[np.lexsort((rows["start"], rows["id"]))]
    a, b = rows["start"], rows["start"] + rows["run"] - 1 + depth
    return _merged(rows["id"], a, b)


def _merged(i: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Sorted spans of documents, overlapping and touching ones joined."""
    if len(i):
        group = np.cumsum(np.append(0, i[1:] != i[:-1]))
        reach = b + group * (1 << 42)  # ends grow from document to document, so one running maximum serves all
        top = np.maximum.accumulate(reach)
        new = np.ones(len(i), bool)
        new[1:] = (a[1:] + group[1:] * (1 << 42)) > top[:-1]
        last = np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)
        i, a, b = i[new], a[new], top[last] - group[last] * (1 << 42)
    zero = np.zeros(len(i), np.int64)
    return _batch(zero, zero, i, a, b, np.zeros(len(i), np.int32))


NAMES = ["digit", "cell", "id", "start", "run", "kind"]
SCHEMA = "digit long, cell long, id long, start long, run long, kind int"


def _batch(digit, cell, i, start, run, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (digit, cell, i, start, run, kind)], names=NAMES)


def _some(batches: Iterator[pa.RecordBatch], megabytes: int = 8):
    """Parts of batches with some megabytes of text each, so that the rows made from them stay few enough to sort."""
    for whole in batches:
        _, off = textops.byte_view(whole.column(1))
        for i, j in textops.blocks(off, megabytes << 20):
            b = whole.slice(i, j - i)
            yield b, *textops.byte_view(b.column(1))


def _first_cells(depth: int, digit: int):
    """Rows of kind 1: the first of equal cells in this batch. Rows of kind 0: spans that the others remove.

    A span row has its first byte in ``start`` and its end in ``run``; ``digit`` spreads these rows over partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in _some(batches):
            ids = b.column(0).fill_null(LOWEST).to_numpy(zero_copy_only=False)
            parts = []
            for i, j in textops.blocks(off):
                doc, dig, cell, start, count = cells(data[off[i] : off[j]], off[i : j + 1] - off[i], depth, digit)
                rows = np.empty(len(doc), ROW)
                rows["digit"], rows["cell"], rows["id"], rows["start"], rows["run"] = dig, cell, ids[i:j][doc] if len(doc) else 0, start, count
                parts.append(rows)
            if not parts:
                continue
            rows = np.concatenate(parts)
            rows = rows[np.lexsort((rows["start"], rows["id"], rows["cell"], rows["digit"]))]
            again = _again(rows)
            spans = _spans(rows[again], depth)
            key = textops.mix64(spans.column(2).to_numpy().view(np.uint64)).view(np.int64)
            yield spans.set_column(0, "digit", pa.array(key))
            rows = rows[~again]
            yield _batch(*(rows[c] for c in NAMES[:5]), np.ones(len(rows), np.int32))

    return run


def _again(rows: np.ndarray) -> np.ndarray:
    """Of sorted rows, those whose digit, and cell are as in the row before, but at another place."""
    same = np.zeros(len(rows), bool)
    same[1:] = (rows["digit"][1:] == rows["digit"][:-1]) & (rows["cell"][1:] == rows["cell"][:-1])
    # repeated rows of a document give the same place twice: not a repeat of itself
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
    moved = (rows["id"] != rows["id"][head]) | (rows["start"] != rows["start"][head])
    return same & moved


def _settle(depth: int):
    """Spans (kind 0) of all but the first of equal cells, and the first cells (kind 1), from rows sorted by kind, digit, cell and place.

    Only the first row of the last cell is held over from batch to batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.empty(0, ROW)
        for b in batches:
            ready = b.filter(pc.equal(b.column(5), 0))
            if ready.num_rows:
                yield ready
            b = b.filter(pc.equal(b.column(5), 1))
            if not b.num_rows:
                continue
            rows = np.empty(b.num_rows, ROW)
            for k, name in enumerate(NAMES[:5]):
                rows[name] = b.column(k).to_numpy(zero_copy_only=False)
            rows = np.concatenate([last, rows])
            again = _again(rows)
            if again.any():
                yield _spans(rows[again], depth)
            new = np.ones(len(rows), bool)
            new[1:] = (rows["digit"][1:] != rows["digit"][:-1]) | (rows["cell"][1:] != rows["cell"][:-1])
            # a row of the same place (a repeated input row) is neither a repeat nor another cell
            firsts = rows[new][len(last) :]
            last = rows[np.flatnonzero(new)[-1:]]
            if len(firsts):
                yield _batch(*(firsts[c] for c in NAMES[:5]), np.ones(len(firsts), np.int32))

    return run


def _window_rows(depth: int):
    """Of the windows of mixed cells, in their texts: the first of equal ones (kind 1), and spans of the others (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in _some(batches, 2):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for i, j in textops.blocks(off):
                h, inverse = textops.prefix_hash(data[off[i] : off[j]], 202)
                flat = b.column(2).slice(i, j - i).flatten()
                if not len(flat):
                    continue
                lens = np.diff(b.column(2).slice(i, j - i).offsets.to_numpy())
                doc = np.repeat(np.arange(j - i), lens)
                start, count, dig, parts_of = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "run", "digit", "parts"))
                end = start + count - 1 + depth
                fits = end <= (off[i + 1 : j + 1] - off[i:j])[doc]  # always, unless texts differ under one id
                doc, start, count, dig, parts_of = doc[fits], start[fits], count[fits], dig[fits], parts_of[fits]
                if not len(doc):
                    continue
                at = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row = np.repeat(np.arange(len(doc)), count)
                place = at + (off[i:j] - off[i])[doc[row]]
                rows = np.empty(len(at), PART_ROW)
                rows["digit"], rows["id"], rows["start"], rows["run"] = dig[row], ids[i:j][doc[row]], at, 1
                window = textops.mix64((h[place + depth] - h[place]) * inverse[place])
                rows["cell"], rows["part"] = window.view(np.int64), (window % parts_of[row].astype(np.uint64)).view(np.int64)
                parts.append(rows)
            if not parts:
                continue
            rows = np.concatenate(parts)
            rows = rows[np.lexsort((rows["start"], rows["id"], rows["cell"], rows["digit"]))]
            again = _again(rows)
            spans = _spans(rows[again], depth)
            key = textops.mix64(spans.column(2).to_numpy().view(np.uint64)).view(np.int64)
            yield _packed(key, np.zeros(len(key), np.int64), spans.column(2), spans.column(3), spans.column(4), [None] * len(key))
            rows = rows[~again]
            rows = rows[np.lexsort((rows["start"], rows["id"], rows["part"], rows["digit"]))]
            new = np.ones(len(rows), bool)
            new[1:] = (rows["digit"][1:] != rows["digit"][:-1]) | (rows["part"][1:] != rows["part"][:-1]) | (rows["id"][1:] != rows["id"][:-1]) | (rows["start"][1:] >= rows["start"][:-1] + depth)
            at = np.append(np.flatnonzero(new), len(rows))
            first = rows[new]
            step = (rows["start"] - np.repeat(first["start"], np.diff(at))).astype("<u4")
            packed = [step[x:y].tobytes() + rows["cell"][x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            yield _packed(first["digit"], first["part"], first["id"], first["start"], np.diff(at), packed)

    return run


PACKED = "digit long, part long, id long, start long, run long, windows binary"


def _packed(digit, part, i, start, run, windows) -> pa.RecordBatch:
    """One row for a cell's windows of one part: places from ``start`` on (4 bytes each), then hashes (8 each). No windows: a span."""
    arrays = [pa.array(np.ascontiguousarray(x)) for x in (digit, part, i, start, run)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(windows, pa.binary())], names=["digit", "part", "id", "start", "run", "windows"])


def _settle_windows(depth: int):
    """Spans of all but the first of equal windows, from packed rows sorted by digit and part: (id, start, end)."""

    def groups(batches):
        """Batches of whole groups; what a batch's last group has is joined once, when the group ends."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            ready = b.filter(b.column(5).is_null())
            if ready.num_rows:
                yield [ready], True
            b = b.filter(b.column(5).is_valid())
            if not b.num_rows:
                continue
            digit, part = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            other = np.flatnonzero((digit != digit[-1]) | (part != part[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if held and (cut or (held[-1].column(0)[-1], held[-1].column(1)[-1]) != (b.column(0)[0], b.column(1)[0])):
                yield [*held, b.slice(0, cut)], False
                held = []
            elif cut:
                yield [b.slice(0, cut)], False
            held.append(b.slice(cut))
        if held:
            yield held, False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "end"]
        for group, spans in groups(batches):
            if spans:
                yield pa.RecordBatch.from_arrays([group[0].column(k) for k in (2, 3, 4)], names=names)
                continue
            parts = []
            for b in group:
                digit, _, i, start, count = (b.column(k).to_numpy(zero_copy_only=False) for k in range(5))
                bodies = b.column(5).to_pylist()
                rows = np.empty(int(count.sum()), ROW)
                rows["digit"], rows["id"], rows["run"] = np.repeat(digit, count), np.repeat(i, count), 1
                step = np.frombuffer(b"".join(x[: 4 * k] for x, k in zip(bodies, count.tolist())), "<u4")
                rows["start"] = np.repeat(start, count) + step
                rows["cell"] = np.frombuffer(b"".join(x[4 * k :] for x, k in zip(bodies, count.tolist())), "<i8")
                parts.append(rows)
            rows = np.concatenate(parts)
            rows = rows[np.lexsort((rows["start"], rows["id"], rows["cell"], rows["digit"]))]
            again = _again(rows)
            if again.any():
                found = _spans(rows[again], depth)
                yield pa.RecordBatch.from_arrays([found.column(2), found.column(3), found.column(4)], names=names)

    return run


def _mixed_cells(firsts: DataFrame) -> DataFrame:
    """The first cells whose digit has other cells too, with the number of parts that the digit's windows are dealt to.

    Distinct cells are counted by an aggregate on the map side. A filter of fixed size comes before the join, and the stored
    counts let Spark split a digit that many cells have.
    """
    many = kept(firsts.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digit", F.ceil(F.col("n") / CELLS).cast("long").alias("parts")))
    some = firsts.mapInArrow(_only_digits(id_filter(many, "digit")), SCHEMA)
    return kept(some.join(F.broadcast(many) if many.count() <= BROADCAST_ROWS else many.hint("merge"), "digit").select("digit", "id", "start", "run", "parts"))


def _only_digits(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(may_hold(bits, b.column(0).to_numpy(zero_copy_only=False))))

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """(id, spans): for each document with repeats, the (start, end) byte spans that repeated windows cover, in order.

    Spans may overlap. A null id is given as the smallest long.
    """
    if not 1 <= digit <= depth:
        raise ValueError("digit must be between 1 and depth")
    d = id_and_text(docs, id_col, text_col)
    rows = d.mapInArrow(_first_cells(depth, digit), SCHEMA).repartition("digit", "cell").sortWithinPartitions("kind", "digit", "cell", "id", "start")
    found = kept(rows.mapInArrow(_settle(depth), SCHEMA))
    cells_of = _mixed_cells(found.where("kind = 1"))
    mixed = cells_of.groupBy("id").agg(F.collect_set(F.struct("start", "run", "digit", "parts")).alias("cells"))
    texts = d.mapInArrow(_only(id_filter(cells_of)), "id long, text string")
    windows = texts.join(mixed, "id").select("id", "text", "cells").mapInArrow(_window_rows(depth), PACKED)
    windows = windows.repartition("digit", "part").sortWithinPartitions("digit", "part")
    borders = windows.mapInArrow(_settle_windows(depth), "id long, a long, b long")
    spans = found.where("kind = 0").select("id", F.col("start").alias("a"), F.col("run").alias("b")).unionByName(borders)
    return spans.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def _only(bits: np.ndarray):
    """The rows whose id may be in a filter; null ids as the smallest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).fill_null(LOWEST)
            b = pa.RecordBatch.from_arrays([ids, b.column(1)], names=["id", "text"])
            yield b.filter(pa.array(may_hold(bits, ids.to_numpy(zero_copy_only=False))))

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _whole(bits: np.ndarray, keep_text: bool):
    """Results of the documents without spans; the others keep their text, to meet their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = textops.byte_view(b.column(1))
            view = memoryview(data)
            later = may_hold(bits, b.column(0).fill_null(LOWEST).to_numpy(zero_copy_only=False))
            parts = [None if w else bytes(view[x:y]) for w, x, y in zip(later.tolist(), off[:-1].tolist(), off[1:].tolist())]
            text = pa.array([bytes(view[x:y]) if w else None for w, x, y in zip(later.tolist(), off[:-1].tolist(), off[1:].tolist())], pa.binary())
            sha = pa.array([None if x is None else hashlib.sha256(x).hexdigest() for x in parts], pa.string())
            body = pa.array(parts if keep_text else [None] * len(parts), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), text, sha, body], names=["id", "n", "text", "sha", "body"])

    return run


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_removed, n_spans, sha, rest = [], [], [], []
            for n, text, done, body, spans in zip(*(b.column(k) for k in range(1, 6))):
                if done.is_valid:
                    n_removed.append(0)
                    n_spans.append(0)
                    sha.append(done.as_py())
                    rest.append(body.as_py())
                    continue
                view = memoryview(text.as_buffer())
                size, runs, gone, parts, last, end = len(view), 0, 0, [], 0, -1
                for x in spans.as_py() or ():
                    a, e = x["a"], min(x["b"], size)
                    if a >= e:
                        continue
                    if a > end:
                        runs += 1
                        parts.append(bytes(view[last:a]))
                        gone += e - a
                    elif e > end:
                        gone += e - end
                    end = last = max(end, e)
                parts.append(bytes(view[last:]))
                left = b"".join(parts)
                n_removed.append(gone)
                n_spans.append(runs)
                sha.append(hashlib.sha256(left).hexdigest())
                rest.append(left)
            out = [b.column(0), b.column(1), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(out + [pa.array(rest, pa.binary())] * keep_text, names=names + ["kept"] * keep_text)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, digit: int = DIGIT, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row; with ``keep_text`` also the bytes left (``kept``).

    Each byte that a ``depth``-byte string covers which also starts earlier is removed. Null and empty texts, and texts
    shorter than ``depth``, have no windows and stay whole. A row that repeats an id and its text isn't a repeat of itself:
    both rows get that document's result. Rows of different texts under one id are located by the id alone: spans found
    in one hold for all, cut to their lengths. A null id is the first of all.
    """
    spans = kept(repeated_spans(docs, id_col, text_col, depth, digit))
    rows = id_and_text(docs, id_col, text_col).mapInArrow(_whole(id_filter(spans), keep_text), "id long, n long, text binary, sha string, body binary")
    joined = rows.join(spans.withColumnRenamed("id", "key"), F.coalesce("id", F.lit(LOWEST)) == F.col("key"), "left")
    joined = joined.select("id", "n", "text", "sha", "body", "spans")
    return joined.mapInArrow(_cut(keep_text), RESULT + ", kept binary" * keep_text)
