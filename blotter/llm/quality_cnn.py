"""Quality classifier: a byte-level convolutional network in numpy.

Each of ``FILTERS`` learned filters spans ``WIDTH`` bytes (a weight per byte value and place). A text is read in overlapping
chunks that cover all of it; a filter's answer in a chunk is its maximum there, and the mean over the chunks goes
through a second layer to one probability. Fitted on the driver on a bounded sample of labelled rows: the ``SAMPLE``
training ids with the smallest hash, one text each, of which at most ``FIT_BYTES`` evenly spread over the text. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import id_and_text

FILTERS, WIDTH, HIDDEN = 32, 4, 16
CHUNK, STEP = 256, 224
SAMPLE, FIT_BYTES, EPOCHS = 1500, 20_000, 12
THRESHOLD = 0.3


def chunk_starts(size: int) -> np.ndarray:
    """Starts of a text's chunks: every STEP bytes until one reaches the end. An empty text is one empty chunk."""
    return np.arange(max(1, -(-(size - CHUNK) // STEP) + 1)) * STEP


def pooled(data: np.ndarray, tables: np.ndarray, with_places: bool = False):
    """The largest answer of each filter in each chunk of one text (chunks x filters), and where it was."""
    starts = chunk_starts(len(data))
    # the text is read as if zero bytes followed it, so that a chunk has at least one place
    body = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)]) if len(data) else np.zeros(WIDTH, np.uint8)
    n = len(body) - WIDTH + 1
    out = np.empty((len(starts), tables.shape[2]), np.float32)
    places = np.empty(out.shape, np.int64) if with_places else None
    group = 256  # chunks at a time: memory stays bounded on long texts
    for g in range(0, len(starts), group):
        part = starts[g : g + group]
        lo, hi = int(part[0]), min(n, int(part[-1]) + CHUNK)
        answer = tables[0][body[lo:hi]]
        for k in range(1, WIDTH):
            answer += tables[k][body[lo + k : hi + k]]
        for i, a in enumerate(part.tolist()):
            seen = answer[a - lo : a - lo + CHUNK]
            if with_places:
                at = seen.argmax(0)
                places[g + i] = at + a
                out[g + i] = seen[at, np.arange(seen.shape[1])]
            else:
                out[g + i] = seen.max(0)
    return (out, places, body) if with_places else out


def _forward(chunks: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, float]:
    mean = np.maximum(chunks, 0).mean(0)
    hidden = np.tanh(mean @ model["w1"] + model["b1"])
    z = float(hidden @ model["w2"] + model["b2"])
    return mean, hidden, 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(data: np.ndarray, model: dict) -> float:
    return float(_forward(pooled(data, model["tables"]), model)[2])


def fit(texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Adam on single texts in a random order; the rarer class weighs up to four times as much."""
    rng = np.random.default_rng(seed)
    model = {
        "tables": rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32),
        "w1": rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32), "b1": np.zeros(HIDDEN, np.float32),
        "w2": rng.normal(0, 0.3, HIDDEN).astype(np.float32), "b2": np.zeros((), np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    share = max(1, int((y == 1).sum())) / max(1, int((y == 0).sum()))
    weight = {0: min(4.0, max(1.0, share)), 1: min(4.0, max(1.0, 1 / share))}
    data = [np.frombuffer(t, np.uint8) for t in texts]
    batch, t = 16, 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(data))
        for lo in range(0, len(order), batch):
            g = {k: np.zeros_like(v) for k, v in model.items()}
            part = order[lo : lo + batch]
            for i in part:
                chunks, places, body = pooled(data[i], model["tables"], True)
                mean, hidden, p = _forward(chunks, model)
                d = (p - y[i]) * weight[int(y[i])] / len(part)
                g["w2"] += d * hidden
                g["b2"] += d
                dh = d * model["w2"] * (1 - hidden**2)
                g["w1"] += np.outer(mean, dh)
                g["b1"] += dh
                dm = (model["w1"] @ dh) / len(chunks) * (chunks > 0)
                column = np.broadcast_to(np.arange(FILTERS), places.shape)
                for k in range(WIDTH):
                    np.add.at(g["tables"][k], (body[places + k], column), dm)
            t += 1
            for k, v in model.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                model[k] = (v - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def held_out(id_column):
    """Whether a row is kept from training: crc32 of its id, as text, divides by 5 without a remainder."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def spread_bytes(text: bytes, most: int = FIT_BYTES) -> bytes:
    """A text of at most ``most`` bytes as it is; of a longer one so many, as chunks at even distances from its start to its end."""
    if len(text) <= most:
        return text
    n = max(1, most // CHUNK)
    return b"".join(text[a : a + CHUNK] for a in np.linspace(0, len(text) - CHUNK, n).astype(np.int64).tolist())


def _training_rows(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spread_bytes(t.as_py().encode(), most) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()), b.column(2)], names=["id", "text", "y"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE,
          fit_bytes: int = FIT_BYTES) -> dict | None:
    """The fitted network, or None without training labels of both kinds. Held-out rows take no part.

    At most ``sample`` rows of ``fit_bytes`` each reach the driver. Of rows with one id the last text counts, by order of texts: a repeated id is one row,
    merged on the map side. Null texts aren't learned from.
    """
    y = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    y = y.where("id is not null and y in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    y = y.orderBy(F.xxhash64("id"), "id").limit(sample)
    d = id_and_text(docs, id_col, text_col).where("text is not null").join(F.broadcast(y), "id")
    d = d.groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y"))
    rows = d.select("id", "text", "y").mapInArrow(_training_rows(fit_bytes), "id long, text binary, y int").collect()
    rows.sort(key=lambda r: r["id"])
    if len({r["y"] for r in rows}) < 2:
        return None
    return fit([bytes(r["text"]) for r in rows], np.array([r["y"] for r in rows]))


def _score_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = textops.byte_view(b.column(1))
            got = np.array([score(data[i:j], model) if model else 1.0 for i, j in zip(off[:-1], off[1:])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; the score is the probability of label 1.

    Null texts count as empty, and empty texts are scored as such. A null id isn't held out. Without training labels of both kinds
    every score is 1. Only the text is an input of the score.
    """
    model = train(docs, labels, id_col, text_col, label_col, sample)
    out = id_and_text(docs, id_col, text_col).mapInArrow(_score_rows(model), "doc_id long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", predicted.cast("int").alias("predicted"))
