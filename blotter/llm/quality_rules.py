"""Quality rules: base counts of each text, and a calibrated logistic regression on hashed word and character n-grams.

Features are square roots of the shares of hashed n-grams: character 3-grams (bytes) in one half, words and word pairs in
the other. The regression is fitted on a bounded sample of labelled rows (the ``sample`` ones with the smallest hash of their
id), calibrated (Platt) on a fifth of the sample that the fit doesn't see, and scores every text in Arrow batches against a fixed
threshold. Counts and scores are of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import id_and_text

BITS = 11  # of each half
SAMPLE = 2500
#: Documents whose features are held at once.
GROUP = 256
#: A text stays if its calibrated probability of quality 1 is at least this.
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document of a block."""
    n = len(off) - 1
    s, e, w = textops.word_bounds(data, off)
    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # bytes that begin a code point
    doc = np.repeat(np.arange(n), np.diff(w))
    chars = np.bincount(doc, lead[e] - lead[s], n).astype(np.int64)
    symbol = np.zeros(256, bool)
    symbol[np.frombuffer(SYMBOLS, np.uint8)] = True
    marks = np.append(0, np.cumsum(symbol[data]))
    lines = []
    view = memoryview(data)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        full = [x for x in bytes(view[a:b]).split(b"\n") if x.strip(textops.WHITE)]
        lines.append(len(full) - len(set(full)))
    repeat = np.zeros(n, np.int64)
    if len(s) >= 3:
        # a 3-word window is keyed by its words and its document; windows across documents are left out
        at = np.flatnonzero(doc[:-2] == doc[2:])
        key = textops.window_sums(textops.word_hashes(data, s, e, 31), 3, 32)[at] ^ textops.mix64(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        often = np.zeros(len(at), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        covered = np.zeros(len(s), bool)
        for k in range(3):
            covered[at[often] + k] = True
        repeat = np.bincount(doc[covered], minlength=n).astype(np.int64)
    return dict(zip(COUNTS, (np.diff(w), chars, marks[off[1:]] - marks[off[:-1]], np.array(lines, np.int64), repeat)))


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> np.ndarray:
    """A row of 2 ** (bits + 1) float32 for each document of a block; all zero for one without words."""
    n, size = len(off) - 1, 1 << bits
    out = np.zeros((n, 2 * size), np.float32)
    if len(data) >= 3:
        x = data.astype(np.uint32)
        gram = x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)
        gram = (gram * np.uint32(0x27D4EB2F)) >> np.uint32(32 - bits)
        doc = np.repeat(np.arange(n), np.diff(off))
        inside = doc[:-2] == doc[2:]
        out[:, :size] = np.bincount(doc[:-2][inside] * size + gram[inside], minlength=n * size).reshape(n, size)
    s, e, w = textops.word_bounds(data, off)
    if len(s):
        h = textops.word_hashes(data, s, e, 41, fold=True)
        doc = np.repeat(np.arange(n), np.diff(w))
        both = np.flatnonzero(doc[:-1] == doc[1:])
        key = np.concatenate([doc * size + (h >> np.uint64(64 - bits)).astype(np.int64),
                              doc[both] * size + (textops.window_sums(h, 2, 42)[both] >> np.uint64(64 - bits)).astype(np.int64)])
        out[:, size:] = np.bincount(key, minlength=n * size).reshape(n, size)
    for half in (out[:, :size], out[:, size:]):
        half /= np.maximum(half.sum(1, keepdims=True), 1)
    return np.sqrt(out, out=out)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on all rows; classes weigh alike, so the rare one counts."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        d = (sigmoid(x @ w + b).astype(np.float32) - y) * weight
        g, gb = x.T @ d + l2 * w, float(d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's scale and shift of scores z by Newton steps, with his smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * z + b)
        h = p * (1 - p) + 1e-9
        g = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum()]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    textops.enter("quality_rules")
    for b in batches:
        data, off = textops.byte_view(b.column(1))
        rows = []
        for i, j in textops.blocks(off, most=GROUP):
            rows += [r.astype(np.float16).tobytes() for r in features(data[off[i] : off[j]], off[i : j + 1] - off[i])]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary()), b.column(2)], names=["id", "x", "y"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE):
    """(weights, bias, scale, shift), or None without labels of both kinds. At most ``sample`` rows reach the driver.

    Of rows with one id the last text counts, by order of texts: a repeated id is one row here, merged on the map side.
    """
    y = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    y = y.where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    y = y.orderBy(F.xxhash64("id"), "id").limit(sample)
    d = id_and_text(docs, id_col, text_col)
    d = d.join(F.broadcast(y), "id").groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y"))
    rows = d.select("id", "text", "y").mapInArrow(_sample_features, "id long, x binary, y int").collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    if len({r["y"] for r in rows}) < 2:
        return None
    x = np.array([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    y = np.array([r["y"] for r in rows])
    kept_out = np.arange(len(y)) % 5 == 4
    w, b = fit(x[~kept_out], y[~kept_out])
    scale, shift = calibrate(x[kept_out] @ w + b, y[kept_out]) if len(set(y[kept_out])) == 2 else (1.0, 0.0)
    return w, b, scale, shift


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def _score(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("quality_rules")
        for b in batches:
            data, off = textops.byte_view(b.column(1))
            parts, scores = [], []
            for i, j in textops.blocks(off, most=GROUP):
                d, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                parts.append(base_counts(d, o))
                if model is None:
                    scores.append(np.ones(j - i))
                else:
                    w, bias, scale, shift = model
                    # sums of each row alone, so a score doesn't depend on the rows beside it
                    z = np.einsum("ij,j->i", features(d, o).astype(np.float64), w.astype(np.float64)) + bias
                    scores.append(sigmoid(scale * z + shift))
            if not parts:
                continue
            c = {k: np.concatenate([p[k] for p in parts]) for k in COUNTS}
            score, failed = np.concatenate(scores), base_failed(c)
            arrays = [b.column(0), *(pa.array(c[k].astype(np.int64)) for k in COUNTS), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return run


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                     threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) of each row.

    Null and empty texts have no words and fail the base rules. Without usable labels (none, or of one kind only) the base rules
    decide alone and the score is 1. Labels of null or repeated ids: the first are left out, of the others the higher counts.
    """
    model = train(docs, labels, id_col, text_col, label_col, sample)
    return id_and_text(docs, id_col, text_col).mapInArrow(_score(model, threshold), SCHEMA)


def _keep(model, threshold: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("quality_rules")
        for b in batches:
            text = b.column(at).cast(pa.string())
            for got in _score(model, threshold)(iter([pa.RecordBatch.from_arrays([pa.array(np.arange(b.num_rows)), text], names=["id", "text"])])):
                yield b.filter(got.column(COUNTS.index("n_repeat_words") + 3))

    return run


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` with the verdict kept, all columns unchanged, in one pass without a join."""
    model = train(docs, labels, id_col, text_col, label_col, sample)
    return docs.mapInArrow(_keep(model, threshold, docs.columns.index(text_col)), docs.schema)
