"""Vector code compression: each part of a vector becomes the index of its codebook's nearest entry, found by Orchard's search.

A vector's components become the integers floor(SCALE * x), so that all sums and distances are exact and no result depends on the order
of rows. It is cut into ``PARTS`` equal consecutive parts, each with a codebook of ``ENTRIES`` entries: Lloyd's rounds start from the parts
of the smallest ids; a round assigns all parts (one pass over the table, in Python workers) and sums them per entry (on the map side,
then by an aggregate of at most ``ENTRIES`` rows a component). The driver holds only codebooks: ``ENTRIES`` integers a component.

Orchard's search: every entry has a list of all entries by their distance from it. A search walks the list of the best entry so far; an
entry that is nearer (or as near, with a lower index) becomes the best one and its list is walked instead. Entries once measured are marked and not
measured again. A list's walk ends beyond twice the best distance: by the triangle inequality no entry there is as near.

Defined results, for all functions:

- Rows whose vector is null, or holds a null or non-finite component, are dropped. Empty vectors stay, without a code.
- The first kept row by (id, vector) states the number of components; rows of another length take no part and get null code and error.
  A length that ``PARTS`` doesn't divide is filled up with zeros.
- Rows without an id are coded, but no codebook starts from them. Of rows with equal ids, the smallest vector starts one.
- With fewer ids than ``ENTRIES``, codebooks are that much shorter; with none, codes and errors are null.
- Scaled components beyond 2**62 count as 2**62. An error that no long holds is null, and so is a sum with such an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.shared import kept
from blotter.operators.joins import measured_bytes

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 62
#: Sums of errors by label are broadcast up to this measured size; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Vectors that one numpy pass holds.
BLOCK = 8192


def scaled(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as int64, held to +-2**62."""
    with np.errstate(over="ignore"):
        y = np.floor(np.asarray(x, np.float64) * scale)
    big = np.abs(y) >= LARGEST
    out = np.where(big, 0, y).astype(np.int64)
    out[big] = np.where(y[big] > 0, LARGEST, -LARGEST)
    return out


def exact_type(*arrays: np.ndarray) -> type:
    """int64 where squared distances between any of the rows, four times over, fit it; else Python's integers."""
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    width = max((a.shape[1] for a in arrays), default=1)
    return np.int64 if 16 * top * top * max(1, width) < 1 << 63 else object


def orchard(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``points`` the index of the nearest row of ``entries`` (ties: the lowest) and the squared distance.

    All points are searched at once: a step takes the next entry of each point's own list.
    """
    kind = exact_type(points, entries)
    x, c = points.astype(kind), entries.astype(kind)
    n, k = len(x), len(c)
    apart = ((c[:, None, :] - c[None, :, :]) ** 2).sum(2)
    lists = np.argsort(apart, axis=1, kind="stable")  # neighbours by distance, ties by index
    best = np.zeros(n, np.int64)
    near = ((x - c[0]) ** 2).sum(1)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    at = np.zeros(n, np.int64)
    walk = np.arange(n)
    while len(walk):
        e = lists[best[walk], at[walk]]
        go = (apart[best[walk], e] <= 4 * near[walk]).astype(bool)  # squares: beyond twice the best distance nothing is as near
        walk, e = walk[go], e[go]
        at[walk] += 1
        new = ~seen[walk, e]
        p, e = walk[new], e[new]
        seen[p, e] = True
        d = ((x[p] - c[e]) ** 2).sum(1)
        better = ((d < near[p]) | ((d == near[p]) & (e < best[p]))).astype(bool)
        q = p[better]
        best[q], near[q], at[q] = e[better], d[better], 0
        walk = walk[at[walk] < k]
    return best, near


def _fitting(col, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of that length, their components) of an Arrow column of float lists without nulls."""
    sizes = np.asarray(col.value_lengths().fill_null(-1))
    rows = np.flatnonzero(sizes == length)
    flat = np.asarray(col.take(pa.array(rows)).flatten()) if len(rows) else np.zeros(0)
    return rows, flat.reshape(len(rows), length)


def _parts(x: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """(parts, rows, components of a part), scaled; zeros fill up the last part."""
    y = scaled(x, scale)
    y = np.concatenate([y, np.zeros((len(y), -y.shape[1] % parts), np.int64)], axis=1)
    return y.reshape(len(y), parts, -1).transpose(1, 0, 2)


def _smallest(length: int, most: int):
    """Per task the ``most`` smallest ids with their smallest vectors; at most two lists of that size are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[float]] = {}
        for b in batches:
            rows, flat = _fitting(b.column(1), length)
            ids = np.asarray(b.column(0))[rows]
            for i in np.argsort(ids, kind="stable"):
                key = int(ids[i])
                if len(best) >= most and key > max(best):
                    break
                v = flat[i].tolist()
                if key not in best or v < best[key]:
                    best[key] = v
                if len(best) > most:
                    del best[max(best)]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.list_(pa.float64()))], names=["id", "v"])

    return run


def _sums(books: np.ndarray, length: int, scale: int):
    """Per task the count and the sum of the parts of each entry, a row for each of their components."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, k), np.int64)
        total = np.zeros((parts, k, width), object)
        for b in batches:
            _, flat = _fitting(b.column(0), length)
            for lo in range(0, len(flat), BLOCK):
                x = _parts(flat[lo : lo + BLOCK], parts, scale)
                small = not x.size or int(np.abs(x).max()) < LARGEST // BLOCK
                for p in range(parts):
                    got, _ = orchard(x[p], books[p])
                    count[p] += np.bincount(got, minlength=k)
                    part = np.zeros((k, width), np.int64 if small else object)
                    np.add.at(part, got, x[p] if small else x[p].astype(object))
                    total[p] += part.astype(object)
        p, e, w = np.nonzero(np.broadcast_to((count > 0)[:, :, None], total.shape))
        if len(p):
            sums = pa.array([int(s) for s in total[p, e, w]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(w, pa.int32()), pa.array(count[p, e], pa.int64()), sums],
                                             names=["part", "entry", "place", "n", "total"])

    return run


def _codes(books: np.ndarray | None, length: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, error = np.full(b.num_rows, None, object), np.full(b.num_rows, None, object)
            if books is not None and length:
                rows, flat = _fitting(b.column(2), length)
                for lo in range(0, len(flat), BLOCK):
                    x = _parts(flat[lo : lo + BLOCK], len(books), scale)
                    found = [orchard(x[p], books[p]) for p in range(len(books))]
                    at = rows[lo : lo + BLOCK]
                    code[at] = ["".join(f"{e:02x}" for e in row) for row in np.stack([f[0] for f in found], 1).tolist()]
                    sums = [sum(row) for row in zip(*(f[1].tolist() for f in found))]
                    error[at] = [s if s < 1 << 63 else None for s in sums]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code.tolist(), pa.string()), pa.array(error.tolist(), pa.int64())], names=["id", "label", "code", "error"])

    return run


def _clean(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """(id, label, v) of the rows whose vector is whole, under names of their own."""
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    df = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return df.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _length(df: DataFrame) -> int:
    first = df.where("id is not null").agg(F.min(F.struct("id", "v")).alias("f")).select(F.size("f.v").alias("n")).first()
    return max(0, first["n"] or 0)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> tuple[int, np.ndarray | None]:
    """(number of components, codebooks as parts x entries x components of a part) after ``rounds`` rounds over all rows.

    An entry becomes the floor of its parts' mean; one without parts stays. The codebooks are None without a row that has an id.
    """
    df = _clean(vectors, id_col, vector_col)
    length = _length(df)
    if not length:
        return 0, None
    first = df.where("id is not null").select("id", "v").mapInArrow(_smallest(length, entries), "id long, v array<double>")
    first = first.groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries).collect()
    books = _parts(np.array([r["v"] for r in first]), parts, scale)
    for _ in range(rounds):
        sums = df.select("v").mapInArrow(_sums(books, length, scale), "part int, entry int, place int, n long, total decimal(38,0)")
        books = books.copy()
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return length, books


def codebooks_sha256(books: np.ndarray | None) -> str:
    """Of all entries' components as decimal integers, by part, entry and place, joined by commas."""
    text = "" if books is None else ",".join(str(int(x)) for x in books.reshape(-1))
    return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors: DataFrame, length: int, books: np.ndarray | None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
           scale: int = SCALE) -> DataFrame:
    """(id, label, code, error) of each whole vector: two hex digits a part, and the squared distances of all parts together."""
    df = _clean(vectors, id_col, vector_col, label_col)
    label = df.schema["label"].dataType.simpleString()
    return df.mapInArrow(_codes(books, length, scale), f"id long, label {label}, code string, error long")


def decode(coded: DataFrame, length: int, books: np.ndarray, code_col: str = "code", scale: int = SCALE) -> DataFrame:
    """``coded`` with ``approx``, the entries that a code names, as doubles; null for a code that is null or names none."""
    entries = books.shape[1]
    table = [[[float(x) / scale for x in entry] for entry in part] for part in books.tolist()]

    def place(p: int):
        e = F.conv(F.substring(F.col(f"`{code_col}`"), 2 * p + 1, 2), 16, 10).try_cast("int")
        book = F.array(*[F.array(*[F.lit(x) for x in entry]) for entry in table[p]])
        return F.when((e >= 0) & (e < entries), F.get(book, e))

    whole = F.col(f"`{code_col}`").rlike(f"^[0-9a-f]{{{2 * len(table)}}}$")
    return coded.withColumn("approx", F.when(whole, F.slice(F.concat(*[place(p) for p in range(len(table))]), 1, length)))


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each whole vector, with codebooks trained on all of them.

    ``label_error`` is the error summed over the rows of the same label, null labels together.
    """
    length, books = train(vectors, id_col, vector_col, parts, entries, rounds, scale)
    coded = kept(encode(vectors, length, books, id_col, vector_col, label_col, scale))
    beyond = F.coalesce(F.bool_or(F.col("code").isNotNull() & F.col("error").isNull()), F.lit(False))
    total = F.when(~beyond, F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
    sums = kept(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")))
    sums = F.broadcast(sums) if measured_bytes(sums) <= BROADCAST_BYTES else sums.hint("merge")
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
