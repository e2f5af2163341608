"""Exact dedup by content-defined chunk recipes.

White space is deleted, the rest of a text is cut where a rolling hash of the last 32 bytes says so (so equal texts are
cut alike), and a document becomes a recipe: the ordered list of its chunks' keys. Whole texts never meet:

1. One scan gives the recipes; only recipes that occur twice or more can belong to equal texts.
2. The chunks of those documents are deduplicated by key *and bytes*, map-side first, so each copy of a chunk leaves a
   task once. A key with one body is a verified identifier. A key with several bodies (a collision) gets one identifier
   per body, and the recipes that use it are written anew.
3. Documents are compared by their ordered identifier lists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import fresh, id_and_text, kept, rows_with, without_ids

LEAST, MEAN_BITS, MOST = 1024, 12, 16384
KEY_BYTES = 16


def chunk_ends(body: bytes, least: int = LEAST, mean_bits: int = MEAN_BITS, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``body``: a cut follows a byte where the gear hash of the 32 bytes up to it has
    ``mean_bits`` zero bits; chunks hold ``least`` to ``most`` bytes (the last may be shorter)."""
    if len(body) <= least:
        return [len(body)] if body else []
    gear = np.random.default_rng(5).integers(0, 2**32, 256, dtype=np.uint32)
    cuts: list[np.ndarray] = []
    step = textops.BLOCK_BYTES
    for lo in range(0, len(body), step):  # in pieces with 31 bytes of overlap, so a very long text needs no more memory
        a = max(0, lo - 31)
        h = gear[np.frombuffer(body, np.uint8, min(len(body), lo + step) - a, a)]
        for k in (1, 2, 4, 8, 16):
            shifted = h.copy()
            shifted[k:] += h[:-k] << np.uint32(k)
            h = shifted
        at = np.flatnonzero((h >> np.uint32(32 - mean_bits)) == 0) + a + 1
        cuts.append(at[at > lo])
    ends, last = [], 0
    for c in np.concatenate(cuts).tolist() + [len(body)]:
        while c - last > most:
            last += most
            ends.append(last)
        if c - last >= least or (c == len(body) and c > last):
            ends.append(c)
            last = c
    return ends


def _chunks(body: bytes) -> list[bytes]:
    ends = chunk_ends(body)
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _key(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _bodies(column) -> Iterator[bytes]:
    data, off = textops.byte_view(column)
    view = memoryview(data)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield bytes(view[a:b]).translate(None, textops.WHITE)


def _recipes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("chunk_dedup")
        for b in batches:
            digest, recipe = [], []
            for body in _bodies(b.column(1)):
                digest.append(hashlib.sha256(body).hexdigest())
                recipe.append(b"".join(_key(c, size) for c in _chunks(body)))
            chars = pc.fill_null(pc.utf8_length(b.column(1)).cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), chars, pa.array(digest, pa.string()), pa.array(recipe, pa.binary())],
                                             names=["id", "chars", "sha256", "recipe"])

    return run


def _chunk_rows(size: int):
    """(id, sha256, pos, key, chunk) for each chunk of each row."""
    kinds = pa.schema([("id", pa.int64()), ("sha256", pa.string()), ("pos", pa.int32()), ("key", pa.binary()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("chunk_dedup")
        for b in batches:
            out, held = [], 0
            for i, body in zip(b.column(0).to_pylist(), _bodies(b.column(1))):
                sha = hashlib.sha256(body).hexdigest()
                out += [{"id": i, "sha256": sha, "pos": k, "key": _key(c, size), "chunk": c} for k, c in enumerate(_chunks(body))]
                held += len(body)
                if held > 8 * textops.BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return run


CHUNKS = "id long, sha256 string, pos int, key binary, chunk binary"


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """(id, chars, sha256, ids) of each row; ``ids`` are equal exactly for rows with equal normalised texts."""
    d = id_and_text(docs, id_col, text_col)
    signed = kept(d.mapInArrow(_recipes(key_bytes), "id long, chars long, sha256 string, recipe binary"))
    # stored, so that the join below reads two exchanges: Spark can then split a recipe that thousands of rows have
    often = kept(signed.where("length(recipe) > 0").groupBy("recipe").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("recipe"))
    ids = kept(signed.join(often, "recipe", "left_semi").select("id").distinct())
    rows = rows_with(d, ids) if not signed.where("id is null").limit(1).count() else d
    chunks = rows.mapInArrow(_chunk_rows(key_bytes), CHUNKS)
    bodies = chunks.groupBy("key", "chunk").agg(F.count(F.lit(1)).alias("k"))
    clash = kept(bodies.groupBy("key").agg(F.count(F.lit(1)).alias("bodies")).where("bodies > 1"))
    if not clash.limit(1).count():
        return signed.withColumnRenamed("recipe", "ids")
    # keys with several bodies: the identifier of such a chunk is its body's place among them, found by comparing bodies
    place = Window.partitionBy("key").orderBy("chunk")
    numbered = bodies.join(clash, "key", "left_semi").select("key", "chunk", F.row_number().over(place).alias("variant"))
    one = F.struct("pos", "key", F.coalesce("variant", F.lit(0)).alias("variant"))
    lists = chunks.join(numbered, ["key", "chunk"], "left").groupBy("id", "sha256").agg(F.array_sort(F.collect_set(one)).alias("l"))
    names = F.transform("l", lambda x: F.concat_ws(":", F.hex(x["key"]), x["variant"].cast("string")))
    lists = lists.select(F.col("id").alias("i"), F.col("sha256").alias("s"), F.concat_ws(",", names).cast("binary").alias("named"))
    out = signed.join(lists, F.expr("id <=> i and sha256 = s"), "left")
    return out.select("id", "chars", "sha256", F.coalesce("named", "recipe").alias("ids"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row of ``docs``.

    Of equal texts the row with the most code points stays, then the one with the smallest id; ids of null come last, and
    of rows that agree in all this one stays. A null text counts as empty; empty texts are equal to each other.
    """
    rows = identified(docs, id_col, text_col, key_bytes)
    # ~id falls as id rises, without an overflow
    groups = rows.groupBy("ids").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("chars", F.expr("~id").alias("no"))).alias("top"))
    groups = kept(groups.where("size > 1").select("ids", "size", F.expr("~top.no").alias("keep_id")))  # stored for the same reason
    out = rows.join(groups, "ids", "left")
    alike = Window.partitionBy("sha256", "id").orderBy(F.desc("chars"))
    return out.select(
        F.col("id").alias("doc_id"), F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(alike) == 1))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns. Ids may be null or repeat."""
    groups = kept(exact_groups(docs, id_col, text_col))
    if not groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count():
        return without_ids(docs, kept(groups.where("not kept").select(F.col("doc_id").alias("id"))), id_col)
    # ids alone don't name a row: with the digest of the text they do, up to rows of which one stays
    i, sha, n = (fresh(k, docs.columns) for k in ("copy_id", "copy_sha", "copy_n"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.withColumn(sha, F.sha2(F.translate(text, textops.WHITE.decode(), "").cast("binary"), 256))
    keys = groups.where("kept").select(F.col("doc_id").alias(i), F.col("text_sha256").alias("s"))
    rows = rows.join(keys, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(i)) & (F.col(sha) == F.col("s")), "left_semi")
    alike = Window.partitionBy(sha, F.col(f"`{id_col}`")).orderBy(F.desc(F.length(text)), text)
    return rows.withColumn(n, F.row_number().over(alike)).where(F.col(n) == 1).drop(sha, n)
