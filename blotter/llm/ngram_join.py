"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles reaches num/den. The method:

1. Documents with equal sets are one class; its smallest id stands for it.
2. One order of all shingles: the (at most ``hot``) most frequent ones come last, the rest by hash. Two sets with the
   needed overlap share l shingles within their l-prefixes (n - ceil(num n / den) + l shingles), for any l. This holds
   for every order, so the table of frequent shingles only steers the cost.
3. Shingles met in one prefix only are dropped. Each document takes the l of 1..``levels`` with the least estimated
   cost: the postings its l-prefix reads, and the candidates these can give if each needs l matches. A pair is a
   candidate if it shares min(l, l') shingles of its prefixes and passes the size and position bounds.
4. Candidates are verified on the whole sets. Links first go to the hub of each long posting list (the document that
   shares most of its prefix with most others); pairs that these links already connect can't change a component, and are not built.
5. What has half or more in common with the same hub is one group. A pair of a group that isn't connected by the hub must
   also share differences from it (``_difference_prefixes``), so within a group prefixes of the few differences are joined
   instead of prefixes of the whole sets: thousands of near copies don't give all their pairs.
6. Every other pair that shares enough of its prefixes is verified.

Shingles are compared as 64-bit hashes; within one pair of sets a chance collision has a likelihood below 1e-12.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm import textops
from blotter.llm.shared import components, id_and_text, kept, rows_with, small_batches, without_ids

#: The most frequent shingles that are broadcast (16 bytes each), whatever the size of the corpus.
HOT = 1 << 16
LEVELS = 6
#: Rows of an Arrow batch: they are whole documents, held several times by the executor and its Python worker.
ARROW_ROWS = 1000
#: The same where a row has two whole sets; rows that are sets, or pairs of them to compare, for one stored file.
PAIR_ROWS = 500
SET_ROWS = 250
#: Posting lists from this length on get hub links first.
HUB = 16
#: Hubs that a document is compared with before the other pairs are looked for.
HUBS = 3


def _hot_counts(n: int, share: float):
    """Shingles met in several documents of a batch, with their counts, from the hash range that prefixes come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        top = np.uint64(min(2**64 - 1, int(share * 2**64)))
        sets: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            token, count = np.unique(np.concatenate(sets), return_counts=True)
            many = count >= 3
            return pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(count[many].astype(np.int64))], names=["token", "c"])

        for b in batches:
            for s in textops.shingle_sets(*textops.byte_view(b.column(0)), n):
                sets.append(s[: np.searchsorted(s, top, "right")].copy())  # not a view of the whole set
                if len(sets) == 4000:
                    yield counted()
                    sets = []
        if sets:
            yield counted()

    return run


def _signatures(n: int, num: int, den: int, levels: int, hot: np.ndarray):
    """Per document: set size, digest of the set, and the first shingles in the common order (8 bytes each)."""
    by_value = np.argsort(hot)
    values = hot[by_value]

    def ordered(s: np.ndarray, m: int) -> np.ndarray:
        if not len(values):
            return s[:m]
        at = np.minimum(np.searchsorted(values, s), len(values) - 1)
        is_hot = values[at] == s
        cold = s[~is_hot][:m]
        if len(cold) == m:
            return cold
        rank = by_value[at[is_hot]]  # hot is in the order of falling counts
        return np.concatenate([cold, s[is_hot][np.argsort(-rank)]])[:m]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        for b in batches:
            size, digest, first = [], [], []
            for s in textops.shingle_sets(*textops.byte_view(b.column(1)), n):
                k = len(s)
                size.append(k)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if k else None)
                first.append(ordered(s, k - -(-num * k // den) + levels).tobytes() if k else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(first, pa.binary())],
                names=["id", "n", "digest", "prefix"],
            )

    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, id, n, pos) for each shingle of each prefix."""
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            part = b.slice(i, 2000)
            data, off = textops.byte_view(part.column(2))
            lens = np.diff(off) // 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(data.view(np.int64) if len(data) else np.zeros(0, np.int64)),
                    pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), lens)),
                    pa.array(np.repeat(part.column(1).to_numpy(zero_copy_only=False).astype(np.int32), lens)),
                    pa.array((np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)),
                ],
                names=["token", "id", "n", "pos"],
            )


def _choose_levels(num: int, den: int, levels: int):
    """Keep of each document's shared shingles those of the l-prefix with the least estimated cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                lens = np.diff(b.column(2).offsets.to_numpy())
                row = np.repeat(np.arange(b.num_rows), lens)
                flat = b.column(2).flatten()
                token, pos, df = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("token", "pos", "df"))
                i, n = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                p = n + (-num * n // den)
                costs = []
                for level in range(1, levels + 1):
                    read = np.bincount(row, (df - 1) * (pos < p[row] + level), b.num_rows)
                    # each posting is a row to join; a candidate that needs `level` matches uses up as many of them
                    costs.append(read + read / level * (1 + n / 50))
                # a set of n shingles shares n - p with a partner at least, so more matches can't be asked for
                best = np.minimum(np.argmin(costs, axis=0) + 1, n - p)
                # how much of its first prefix a document shares with how many: the centre of a group of copies has the most
                central = (1000 * np.bincount(row, np.log2(df) * (pos < p[row] + 1), b.num_rows) / (p + 1)).astype(np.int64)
                use = pos < (p + best)[row]
                order = np.flatnonzero(use)
                order = order[np.lexsort((pos[order], row[order]))]
                token, pos, df, row = token[order], pos[order], df[order], row[order]
                # shingles before pos that other prefixes have too
                count = np.bincount(row, minlength=b.num_rows)
                earlier = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                out = [token, i[row], n[row], earlier, pos, np.maximum(1, pos - p[row] + 1), best[row], df, central[row]]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["token", "id", "n", "earlier", "pos", "level", "matches", "df", "central"])

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                sets = [s.tobytes() for s in textops.shingle_sets(*textops.byte_view(b.column(1)), n)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["id", "s"])

    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        for b in batches:
            link = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                both = int((long[at] == short).sum())
                link.append(den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(link, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return run


def _measure(num: int, den: int):
    """How a document x and a hub h compare: link, sizes, and the differences of those that have half or more in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textops.enter("ngram_join")
        for b in batches:
            rows = []
            for x, h in zip(b.column(2), b.column(3)):
                x, h = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(h.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(h, x), len(h) - 1)
                same = h[at] == x
                both = int(same.sum())
                removed, added, union = len(h) - both, len(x) - both, len(x) + len(h) - both
                near = 2 * both >= union
                diff = np.concatenate([np.delete(h, at[same]), x[~same]]).tobytes() if near else None
                rows.append((den * both >= num * union, near, len(x), len(h), removed, added, diff))
            kinds = [pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            out = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *out], names=["x", "h", "link", "near", "n", "hub_n", "removed", "added", "diff"])

    return run


def _explode_differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, token, id, ...) for each difference of each member of a group; the last column holds the differences."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            b = whole.slice(lo, 500)
            data, off = textops.byte_view(b.column(b.num_columns - 1))
            lens = np.diff(off) // 8
            row = pa.array(np.repeat(np.arange(b.num_rows), lens))
            cols = [b.column(k).take(row) for k in range(b.num_columns - 1)]
            token = pa.array(data.view(np.int64) if len(data) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*cols, token], names=["h", "id", "n", "link", "size", "keep", "keep_apart", "token"])


def _difference_prefixes(members: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b) of one group of which the hub connects at most one: a pair that isn't here isn't linked or is connected.

    Let D be the hub's shingles that a document lacks and E those it has besides. A pair (u, v) with the hub h shares
    |h| - D(u) - D(v) + s shingles, s being its shared differences. With r = num / (num + den), it is linked only if
    s >= r (|u| + |v|) - |h| + D(u) + D(v) = r (|u| + |h|) - |h| + D(u) + r E(v) + (1 - r) D(v). As u isn't linked to h,
    the part without v is over -1 + 1 = 0, so s > r E(v) + (1 - r) D(v) also holds. Both bounds give prefixes of the
    differences, in the order of their frequency within the group: first those that no unlinked member shares.
    """
    alone = f"ceil({num} * (n + hub_n) / {num + den}.0) - hub_n + removed"
    other = f"floor(({num} * added + {den} * removed) / {num + den}.0) + 1"
    m = members.withColumn("size", F.expr("removed + added")).withColumn("keep", F.expr(f"size + 1 - if(link, {other}, {alone})")).withColumn("keep_apart", F.expr(f"size + 1 - greatest({other}, {alone})"))
    m = m.selectExpr("h", "x as id", "n", "link", "size", "cast(keep as long) as keep", "cast(keep_apart as long) as keep_apart", "diff").where("keep > 0")
    entries = m.mapInArrow(_explode_differences, "h long, id long, n long, link boolean, size long, keep long, keep_apart long, token long")
    df = entries.groupBy("h", "token").agg(F.count(F.lit(1)).alias("df"), F.bool_and("link").alias("all_linked")).where("df > 1 and not all_linked").drop("all_linked")
    of = Window.partitionBy("id")
    shared = entries.join(df, ["h", "token"]).withColumn("pos", F.col("size") - F.count(F.lit(1)).over(of) + F.row_number().over(of.orderBy("df", "token")))
    posts = kept(shared.where("pos <= keep").select("h", "token", "id", "n", "link", "pos", "keep_apart"))
    a, b = posts.where("not link").alias("a"), posts.alias("b")
    fits = F.expr(
        "a.h = b.h and a.token = b.token and (b.link or (a.id < b.id and a.pos <= a.keep_apart and b.pos <= b.keep_apart))"
        f" and {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)"
    )
    return a.join(b, fits).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, num: int = 90, den: int = 100,
                  hot: int = HOT, levels: int = LEVELS, hub: int = HUB) -> tuple[DataFrame, DataFrame]:
    """(signatures, links): (id, n, digest) of each row, and verified pairs (a, b) between class representatives.

    The links connect exactly the classes that all links together connect; pairs inside one group that earlier links
    already connect are left out.
    """
    with small_batches(docs.sparkSession, ARROW_ROWS):  # what is returned is stored and has no Python step left
        return _similar_pairs(id_and_text(docs, id_col, text_col), shingle, num, den, hot, levels, hub)


def _similar_pairs(d: DataFrame, shingle: int, num: int, den: int, hot: int, levels: int, hub: int) -> tuple[DataFrame, DataFrame]:
    share = min(1.0, 2.5 * (den - num) / den)
    counts = d.select("text").mapInArrow(_hot_counts(shingle, share), "token long, c long")
    top = counts.groupBy("token").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "token").limit(hot).collect()
    table = np.array([r["token"] for r in top], np.int64).view(np.uint64)

    signed = kept(d.mapInArrow(_signatures(shingle, num, den, levels, table), "id long, n long, digest binary, prefix binary"))
    reps = signed.where("n > 0").groupBy("digest", "n").agg(F.min("id").alias("id"), F.first("prefix").alias("prefix"))
    entries = kept(reps.select("id", "n", "prefix")).mapInArrow(_explode, "token long, id long, n int, pos int")
    df = entries.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = entries.join(df, "token").groupBy("id", "n").agg(F.collect_list(F.struct("token", "pos", "df")).alias("shared"))
    cols = "token long, id long, n long, earlier long, pos long, level long, matches long, df long, central long"
    posts = kept(shared.mapInArrow(_choose_levels(num, den, levels), cols))

    a, b = posts.alias("a"), posts.alias("b")
    least_overlap = f"ceil({num} * (a.n + b.n) / {num + den}.0)"
    # an overlap is what is shared before a shingle, and at most what both sets have from it on
    fits = F.expr(
        f"a.level <= b.matches and b.level <= a.matches and {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)"
        f" and least(a.earlier, b.earlier) + least(a.n - a.pos, b.n - b.pos) >= {least_overlap}"
    )
    swap = "a.id < b.id"
    enough = [
        F.max(F.least("a.matches", "b.matches")).alias("need"),
        F.count(F.lit(1)).alias("got"),
        # the same at the first and at the last shared shingle, where what is shared before is known
        F.max(F.expr(f"least(a.n - a.pos, b.n - b.pos) - {least_overlap}")).alias("first"),
        F.min(F.expr(f"if({swap}, a.n - a.pos, b.n - b.pos)")).alias("rest_a"),
        F.min(F.expr(f"if({swap}, b.n - b.pos, a.n - a.pos)")).alias("rest_b"),
        F.max(F.expr(least_overlap)).alias("overlap"),
    ]

    def candidates(joined: DataFrame) -> DataFrame:
        pairs = joined.where(fits).groupBy(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))
        return pairs.agg(*enough).where("got >= need and first >= 0 and got - 1 + least(rest_a, rest_b) >= overlap").select("a", "b")

    def nearest_hubs(joined: DataFrame) -> DataFrame:
        # each document with the hubs it shares most long lists with; what this leaves out, the second part finds
        pairs = joined.where(fits).groupBy(F.col("b.id").alias("x"), F.col("a.id").alias("y")).agg(F.count(F.lit(1)).alias("got"))
        best = F.slice(F.sort_array(F.collect_list(F.struct("got", F.expr("~y").alias("y"))), asc=False), 1, HUBS)  # at most one hub a shingle
        return pairs.groupBy("x").agg(best.alias("best")).select("x", F.expr("explode(best.y)").alias("y")).select(F.col("x").alias("a"), F.expr("~y").alias("b"))

    def compared(pairs: DataFrame, how, schema: str) -> DataFrame:
        pairs = kept(pairs)
        n = pairs.count()
        ids = kept(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), 2 * n)
        sets = rows_with(d, ids).mapInArrow(_sets(shingle), "id long, s binary")
        sets = kept(sets.groupBy("id").agg(F.min("s").alias("s")), ids.count(), SET_ROWS)  # repeated rows of one id count once
        # sets travel in rows of their own until they meet in a pair; small Arrow batches bound what a worker holds
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
        both = both.join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
        with small_batches(d.sparkSession, PAIR_ROWS):
            return kept(both.select("a", "b", "x", "y").mapInArrow(how, schema), n, SET_ROWS)

    def verified(pairs: DataFrame) -> DataFrame:
        return compared(pairs, _verify(num, den), "a long, b long")

    longs = posts.where(f"df >= {hub}")
    hubs = longs.groupBy("token").agg(F.max(F.struct("central", F.expr("~id").alias("no"))).alias("h")).select("token", F.expr("~h.no").alias("id"))
    hub_posts = longs.join(hubs, ["token", "id"], "left_semi").alias("a")
    near_hub = hub_posts.join(longs.alias("b"), F.expr("a.token = b.token and a.id != b.id"))
    schema = "x long, h long, link boolean, near boolean, n long, hub_n long, removed long, added long, diff binary"
    measured = compared(nearest_hubs(near_hub), _measure(num, den), schema)
    to_hubs = measured.where("link").select(F.least("x", "h").alias("a"), F.greatest("x", "h").alias("b")).distinct()

    # Each document joins the group of one hub that is near it: the one that most documents are near.
    near = measured.where("near").select("x", "h")
    popular = near.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    group = near.join(popular, "h").groupBy("x").agg(F.max(F.struct("k", F.expr("~h").alias("no"))).alias("g"))
    group = kept(group.select("x", F.expr("~g.no").alias("h")), measured.count())
    inside = verified(_difference_prefixes(measured.join(group, ["x", "h"]), num, den))

    # Pairs of different groups that aren't yet connected: of each posting list, all but its largest group against the rest.
    early = to_hubs.unionByName(inside)
    comp = components(early, most=early.count()).withColumnRenamed("node", "id")
    placed = posts.join(comp, "id", "left").join(group.select(F.col("x").alias("id"), F.col("h").alias("group")), "id", "left")
    placed = kept(placed.withColumns({"component": F.coalesce("component", "id"), "group": F.coalesce("group", "id")}))
    sizes = placed.groupBy("token", "group").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("token").agg(F.max(F.struct("k", "group")).alias("m")).select("token", F.col("m.group").alias("main"))
    rest = placed.join(main, "token").where("group != main")
    a_side, b_side = rest.alias("a"), placed.join(main, "token").alias("b")
    apart = F.expr("a.token = b.token and a.group != b.group and a.component != b.component and (b.group = b.main or a.id < b.id)")
    second = verified(candidates(a_side.join(b_side, apart)))
    return signed.drop("prefix"), early.unionByName(second)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of each row of ``docs``.

    component_id is the smallest id that a document reaches by links, itself included; class_id is the smallest id
    with the same set. Rows whose text is null, empty or without words have no shingles and are linked with nothing. Rows
    that repeat an id and its text are one node (give each text an id of its own: of different texts under one id that is the smallest
    of its class, only one is verified). An id of null stays null, and such a row isn't linked. Other columns don't matter.
    """
    signed, links = similar_pairs(docs.where(F.col(f"`{id_col}`").isNotNull()), id_col, text_col, **params)
    # links are between classes, so their rows only look up their class; stored, so that Spark can split a class that many rows have
    reps = signed.where("n > 0").groupBy("digest", "n").agg(F.min("id").alias("class_id"))
    comp = components(links, most=links.count()).withColumnRenamed("node", "class_id")
    classes = kept(reps.join(comp, "class_id", "left"))
    out = signed.join(classes, ["digest", "n"], "left")
    out = out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "class_id", "id").alias("component_id"), F.coalesce("class_id", "id").alias("class_id"),
    )
    nulls = docs.where(F.col(f"`{id_col}`").isNull())
    no = F.lit(None).cast("long")
    alone = id_and_text(nulls, id_col, text_col).mapInArrow(_signatures(params.get("shingle", 3), 1, 1, 0, np.zeros(0, np.uint64)), "id long, n long, digest binary, prefix binary")
    return out.unionByName(alone.select(no.alias("doc_id"), F.col("n").alias("n_shingles"), no.alias("component_id"), no.alias("class_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id: one document of each group stays, with all its
    columns. Rows without words or without an id stay."""
    found = jaccard_components(docs, id_col, text_col, shingle=shingle, num=num, den=den)
    return without_ids(docs, kept(found.where("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct()), id_col)
