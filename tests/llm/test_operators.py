"""The training-data operators against brute force, and on edge cases: nulls, empty and long texts, ties, repeats, clashes."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from blotter.llm import chunk_dedup, html_wrapper, ngram_join, packing, quality_cnn, quality_rules, repeat_windows, secret_scan, sentencepiece_codec, shared, textops, token_counts

SMALL = "/root/testdata/sf0.001"
BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
WORDS = [f"w{k}" for k in range(60)]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n int, base string")


def _edge(spark):
    """Null id, null, empty, blank and long texts, a repeated row, columns that clash with internal names."""
    long_text = " ".join(WORDS[k % 57] for k in range(9000))
    texts = [(1, "alpha beta gamma delta"), (2, None), (3, ""), (4, " \t\n"), (5, long_text), (6, "alpha beta  gamma delta "), (6, "alpha beta  gamma delta "),
             (None, "alpha beta gamma delta"), (7, "été 中文 😀 <|endoftext|> x")]
    return _rows(spark, [(i, t, "x", 1, "y") for i, t in texts])


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# ---------------------------------------------------------------- n-gram join


def _sets(text, n):
    w = _words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def _brute_components(rows, n, num, den):
    sets = {i: _sets(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,num,hub", [(3, 90, 3), (5, 80, 16), (1, 60, 2)])
def test_components_equal_brute_force(spark, n, num, hub):
    rng = random.Random(n)
    rows = []
    for g in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 40, 90]))]
        for _ in range(rng.choice([1, 2, 14])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                t[rng.randrange(len(t))] = rng.choice(WORDS + ["rare%d" % rng.randrange(1000)])
            rows.append((len(rows), rng.choice([" ", "\n"]).join(t).upper() if rng.random() < 0.2 else " ".join(t)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, shingle=n, num=num, hub=hub, hot=50).collect()}
    assert got == _brute_components(rows, n, num, 100)


def test_levels_stay_within_the_least_overlap(spark):
    import pyarrow as pa

    shared_by = pa.array([[{"token": k, "pos": k, "df": 1000 if k == 0 else 2} for k in range(n)] for n in (4, 5, 6)])
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), shared_by], names=["id", "n", "shared"])
    out = [r for x in ngram_join._choose_levels(80, 100, 6)(iter([b])) for r in x.to_pylist()]
    assert {r["id"] for r in out} == {1, 2, 3} and all(r["matches"] <= -(-4 * r["n"] // 5) for r in out)
    rows = []
    for g in range(12):
        few = ["the", *(f"g{g}x{k}" for k in range(3 + g % 2))]
        rows += [(len(rows), " ".join(few)), (len(rows) + 1, " ".join([*few, f"more{g}"]))]
    rows += [(k, f"the only{k}") for k in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, shingle=1, num=80).collect()}
    assert got == _brute_components(rows, 1, 80, 100)


def test_branches_far_from_their_hub_stay_linked(spark):
    rng = random.Random(8)
    base = ["w%d" % k for k in range(70)]

    def edited(t, edits):
        t = list(t)
        for k in rng.sample(range(len(t)), edits):
            t[k] = "x%d" % rng.randrange(40) if rng.random() < 0.9 else t[k] + " " + t[k]
        return t

    texts = [edited(base, rng.choice([0, 1, 1, 2, 3])) for _ in range(60)]
    for depth in (2, 3, 4, 6, 9):  # branches that the centre links with or not, each with copies of its own
        branch = edited(base, depth)
        texts += [edited(branch, rng.choice([0, 1, 1, 2])) for _ in range(8)] + [branch[:-depth]]
    rng.shuffle(texts)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    want = _brute_components(rows, 3, 90, 100)
    assert len({c for _, c in want.values()}) > 5 and got == want


def test_components_edges(spark):
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(_edge(spark)).collect()), key=str)
    assert out == sorted([(1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 57, 5), (6, 2, 1), (6, 2, 1), (None, 2, None), (7, 3, 7)], key=str)
    assert ngram_join.jaccard_components(_edge(spark).limit(0)).collect() == []
    left = ngram_join.drop_near_copies(_edge(spark))
    assert left.columns == ["doc_id", "text", "id", "n", "base"]
    assert sorted((str(r.doc_id) for r in left.collect())) == ["1", "2", "3", "4", "5", "7", "None"]  # with fewer than five words the whole sequence is the set, so 1 and 6 are copies


def test_few_rows_are_stored_in_few_files_and_sent_in_small_batches(spark, monkeypatch):
    key, stored, batch = "spark.sql.execution.arrow.maxRecordsPerBatch", [], []

    def kept(df, *limits):
        out = shared_kept(df, *limits)
        stored.append(out.rdd.getNumPartitions())
        batch.append(int(spark.conf.get(key)))
        return out

    shared_kept = shared.kept
    monkeypatch.setattr(shared, "kept", kept)
    monkeypatch.setattr(ngram_join, "kept", kept)
    rng = random.Random(4)
    rows = [(k, " ".join("a%d" % (k % 20 * 100 + j if rng.random() < 0.99 else rng.randrange(9999)) for j in range(60))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", key)}
    try:
        for k, v in zip(before, ("40", "false", "10000")):
            spark.conf.set(k, v)
        signed, links = ngram_join.similar_pairs(df)
        assert links.count() and max(batch) <= 1000 and spark.conf.get(key) == "10000"
        with shared.small_batches(spark, 20_000):
            assert spark.conf.get(key) == "10000"  # a lower limit of the session stays
        stored.clear()
        n = links.count()
        got = {r.node: r.component for r in shared.components(links, most=n).collect()}
        assert stored and max(stored) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {i: c for i, (_, c) in _brute_components(rows, 3, 90, 100).items()}
    assert got and all(want[i] == c for i, c in got.items())


def test_stored_files_grow_with_the_rows(spark):
    df = spark.range(0, 1000, 1, 12)
    assert [shared.kept(df, *x).rdd.getNumPartitions() for x in ((), (0,), (1000, 250), (1001, 250), (1000, 10))] == [12, 1, 4, 5, 12]
    assert shared.kept(df, 1000, 250).count() == 1000


def test_shingling_holds_little_more_than_its_sets():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([" ".join("w%d" % (k * 997 + j) for j in range(300)) for k in range(2000)])
    list(textops.shingle_sets(*textops.byte_view(texts[:10]), 3))  # the table of powers
    data, off = textops.byte_view(texts)
    tracemalloc.start()
    try:
        n = sum(len(s) for s in textops.shingle_sets(data, off, 3))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 2000 * 298 and peak < 12_000_000


def test_counts_of_frequent_shingles_do_not_depend_on_batches():
    import pyarrow as pa

    texts = pa.array([" ".join("w%d" % (k % 400 * 997 + j) for j in range(30)) for k in range(2000)])
    batches = [[pa.RecordBatch.from_arrays([texts[k : k + rows]], names=["text"]) for k in range(0, 2000, rows)] for rows in (2000, 500)]
    one, many = ([r for b in ngram_join._hot_counts(3, 1.0)(iter(x)) for r in b.to_pylist()] for x in batches)
    assert len(one) == 400 * 28 and one == many


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 7), (200, 201)]
    got = {r.node: r.component for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in [*range(1, 41), 100]}, 200: 200, 201: 200}


# ---------------------------------------------------------------- exact dedup


def _brute_groups(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (i, _), x in zip(rows, norm):
        same = [(-len(rows[k][1] or ""), rows[k][0]) for k in range(len(rows)) if norm[k] == x]
        out.append((i, min(same)[1], len(same), min(same)[1] == i, hashlib.sha256(x.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("key_bytes", [16, 1])
def test_exact_groups_equal_brute_force(spark, key_bytes):
    """With keys of one byte many chunks collide: identifiers must then follow the bytes."""
    rng = random.Random(4)
    bodies = ["".join(rng.choice("abcdé \n") for _ in range(rng.choice([0, 5, 300, 9000, 60000]))) for _ in range(25)]
    rows = []
    for k in range(80):
        b = rng.choice(bodies)
        rows.append((k, rng.choice([b, b + "  ", b.replace(" ", "\t"), b[: len(b) // 2]])))
    out = chunk_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), key_bytes=key_bytes).collect()
    assert sorted(tuple(r) for r in out) == _brute_groups(rows)


def test_exact_edges(spark):
    out = chunk_dedup.exact_groups(_edge(spark)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == Counter(
        {(1, 6, 4, False): 1, (6, 6, 4, True): 1, (6, 6, 4, False): 1, (None, 6, 4, False): 1, (2, 4, 3, False): 1, (3, 4, 3, False): 1, (4, 4, 3, True): 1, (5, 5, 1, True): 1, (7, 7, 1, True): 1})
    left = chunk_dedup.drop_copies(_edge(spark))
    assert left.columns == ["doc_id", "text", "id", "n", "base"] and sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7]
    assert chunk_dedup.exact_groups(_edge(spark).limit(0)).collect() == []


def test_chunks_cover_and_follow_content():
    rng = random.Random(1)
    body = bytes(rng.randrange(256) for _ in range(300_000))
    ends = chunk_dedup.chunk_ends(body)
    assert ends[-1] == len(body) and all(0 < b - a <= chunk_dedup.MOST for a, b in zip([0, *ends], ends))
    moved = {c + 777 for c in chunk_dedup.chunk_ends(body)}
    assert len(moved & set(chunk_dedup.chunk_ends(bytes(777) + body))) > 0.8 * len(ends)


# ---------------------------------------------------------------- tokens


def test_token_counts_equal_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BYTE)
    rng = random.Random(2)
    alphabet = list("ab'stlreve 12\n\t\x0b\xa0éß.,;!?$%—…“”€") + ["  ", "\n\n", "'s", "中", "😀", "<|endoftext|>", "\x1c", "\x85"]
    rows = [(k, "".join(rng.choice(alphabet[: 30 if k % 2 else None]) for _ in range(rng.randint(0, 80)))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in token_counts.token_counts(df, BYTE, size=50).collect():
        n = len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_token_edges(spark):
    out = {(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(_edge(spark), BYTE).collect()}
    assert {(2, 0, 0), (3, 0, 0), (None, 22, 4), (1, 22, 4)} <= out
    assert token_counts.token_counts(_edge(spark).limit(0), BYTE).collect() == []


def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(_edge(spark).select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]))
    pieces = packing.pack(docs, WORD, capacity=128, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for r in docs.collect():
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == ids
        assert [p.start for p in parts] == list(range(0, len(ids), 128)) and [p.piece for p in parts] == list(range(len(parts)))
    for v in by_sequence.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 128
    assert len(by_sequence) <= 1.05 * -(-sum(p.length for p in pieces) // 128)


def test_packing_edges(spark):
    out = packing.pack(_edge(spark), WORD).collect()
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter([1, 2, 3, 4, 5, 6, 6, None, 7])
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    assert packing.pack(_edge(spark).limit(0), WORD).collect() == []


def _best(items, capacity):
    """The least number of bins, by exhaustive search."""
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in {x: j for j, x in enumerate(bins)}.values():
            if bins[b] + items[k] <= capacity:
                go(k + 1, bins[:b] + [bins[b] + items[k]] + bins[b + 1 :])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best[0]


def test_dominance_keeps_a_best_packing():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 31])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = dict(Counter(items))
        fixed = packing.reduce_by_dominance(counts, capacity)
        rest = sorted((x for x, k in counts.items() for _ in range(k)), reverse=True)
        assert sum(n for _, n in fixed) + _best(rest, capacity) == _best(items, capacity)
        assert all(sum(x) <= capacity for x, _ in fixed)


def test_codec_equals_library(spark):
    codec = sentencepiece_codec.Codec(PIECE)
    rng = random.Random(5)
    alphabet = list("ab'stlreve 12 \n\t\x85\xa0éßñ.,;!?$—“€中😀▁") + ["  ", "<s>", "the", "ing", "return", "    "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(600)] + ["a" * 700, "ab" * 500, " " * 300, "=" * 333, "e" * 31 + "r" * 60]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == codec.model.encode(t)
        assert codec.decode(ids) == codec.model.decode(codec.model.encode(t)) == t.replace("▁", " ")


def test_streaming_window_commits_early():
    codec = sentencepiece_codec.Codec(PIECE)
    got = codec.pieces(codec.normalise("the quick brown fox " * 200))
    first = [next(got) for _ in range(5)]
    assert first == ["▁the", "▁quick", "▁brown", "▁fo", "x"] or len("".join(first)) < 64
    # a unigram search takes the path with the largest sum of scores
    codec.kind, codec.scores, codec.lengths, codec.longest = "unigram", {"a": -1.0, "b": -1.0, "ab": -1.5, "aba": -4.0}, {"ab": (2, 1), "ba": (3, 1)}, 3
    assert list(codec.pieces("abab")) == ["ab", "ab"]


def test_decode_of_ids_that_the_vocabulary_lacks():
    codec = sentencepiece_codec.Codec(PIECE)
    ids = codec.encode("a word")
    odd = ids + np.array([10**6, 2**32 - 1], "<u4").tobytes() + b"xy"
    assert codec.decode(odd) == "a word" + " \u2047 " * 2 and codec.decode(b"\x01") == ""


def test_memory_of_two_generations():
    memo = textops.Memo(2)
    for k in range(5):
        memo.put(k, -k)
        assert memo.get(0) == 0  # used again, so never lost
    assert memo.get(4) == -4 and memo.get(1) is None and len(memo.new) <= 2 and len(memo.old) <= 2


def test_codec_edges(spark):
    out = {r.doc_id: r for r in sentencepiece_codec.round_trips(_edge(spark), PIECE).collect()}
    assert all(r.round_trip for r in out.values()) and (out[2].n_ids, out[3].n_ids) == (0, 0)
    encoded = sentencepiece_codec.encode(_edge(spark), PIECE)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(encoded, PIECE).collect()}
    assert back[7] == "été 中文 😀 <|endoftext|> x" and back[2] == ""


# ---------------------------------------------------------------- repeated windows


def _brute_repeats(rows, depth):
    seen, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - depth + 1):
            w = b[k : k + depth]
            if w in seen:
                gone[k : k + depth] = b"\1" * depth
            seen.setdefault(w, (i, k))
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("depth,digit", [(100, 32), (20, 8), (12, 12), (9, 1)])
def test_repeats_equal_brute_force(spark, depth, digit):
    rng = random.Random(depth)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.choice([depth - 1, depth, 3 * depth]))) for _ in range(6)] + ["a" * 3 * depth, "ab" * 2 * depth]
    rows = []
    for k in range(40):
        t = "".join(rng.choice([rng.choice(passages), "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 3 * depth)))]) for _ in range(rng.randint(0, 6)))
        rows.append((k, t))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = repeat_windows.remove_repeats(df, depth=depth, digit=digit).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == _brute_repeats(rows, depth)


def test_passage_with_different_neighbours(spark, monkeypatch):
    """At a common passage's edges each document has a cell of its own: one digit, many cells, over many small batches."""
    rng = random.Random(12)
    junk = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, phrase = junk(300), junk(60)
    rows = [(k, junk(rng.randint(0, 150)) + rng.choice([passage, passage, phrase]) + junk(rng.randint(0, 150))) for k in range(150)]
    monkeypatch.setattr(repeat_windows, "CELLS", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    with shared.small_batches(spark, 7):
        out = repeat_windows.remove_repeats(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == _brute_repeats(rows, 100)


def test_windows_of_a_hot_digit_are_dealt_out():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    text = pa.array(["".join(map(chr, rng.integers(97, 123, 130))) for _ in range(50)])
    cells = pa.array([[{"start": 0, "run": 30, "digit": 5, "parts": 40}]] * 50)
    out = [r for b in repeat_windows._window_rows(100)(iter([pa.RecordBatch.from_arrays([pa.array(range(50)), text, cells], names=["id", "text", "cells"])])) for r in b.to_pylist() if r["windows"]]
    load = Counter()
    for r in out:
        load[r["digit"], r["part"]] += r["run"]
    assert sum(load.values()) == 1500 and len(load) == 40 and max(load.values()) < 80


def test_repeats_edges(spark):
    out = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in repeat_windows.remove_repeats(_edge(spark), depth=20, digit=8).collect())
    # the row without an id comes first, so the texts of 1 and 6 repeat its windows; the two rows of 6 are one document
    assert out[(None, 22, 0)] == 1 and out[(1, 22, 22)] == 1 and out[(2, 0, 0)] == 1 and sum(n for k, n in out.items() if k[0] == 6) == 2
    assert repeat_windows.remove_repeats(_edge(spark).limit(0)).collect() == []


# ---------------------------------------------------------------- pages


def _page(k, body, extra=""):
    return (f"<html><head><title>t{k}</title></head><body><div id='top-nav'>Home About {k}</div><p>Welcome to our site</p>{body}"
            f"<div class='box'>Subscribe now for news</div>{extra}<script>var a='<p>no</p>'</script></body></html>")


def test_template_is_learned_and_slots_are_kept(spark):
    pages = [(k, "http://h.example/%d" % k, _page(k, f"<div><p>Body &amp; text {k}\n one<p>Second <b>part</b> {k}<br>end</div>")) for k in range(6)]
    out = {r.page_id: r.text for r in html_wrapper.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {k: f"Body & text {k} one\nSecond part {k} end" for k in range(6)}


def test_article_and_named_elements():
    page = ("<body><header>H</header><nav><ul><li>a</ul></nav><aside>s</aside><article class='post'><header><h1>T&eacute;st</h1></header><p>One<p>Two <i>x</i>"
            "<div class='ad'>buy</div><form>f</form><section id='comments'><p>nice</p></section></article><div class='cookie-notice'>c</div><footer>f</footer>")
    assert html_wrapper.extract([page]) == ["Tést\nOne\nTwo x"]
    assert html_wrapper.extract([page] * 5) == ["Tést\nOne\nTwo x"] * 5  # copies of a page aren't a template
    assert html_wrapper.extract([None, "", "<", "plain", "<p>a<p>cut &am", "x <b"]) == ["", "", "<", "plain", "a\ncut &am", "x"]


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    out = {r.page_id: r for r in html_wrapper.main_texts(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", m[1])]
        want = "\n".join(x for x in blocks if x)
        assert (out[r.page_id].text, out[r.page_id].n_chars, out[r.page_id].url) == (want, len(want), r.url)


def test_page_edges(spark):
    rows = [(1, None, None, "x"), (2, "no host", "", "x"), (3, "http://h/x", "<p>a</p>", "x"), (3, "http://h/x", "<p>a</p>", "x"), (None, "http://h/y", "<p>b</p>", "x")]
    out = html_wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string"), block=2).collect()
    assert Counter((r.page_id, r.text) for r in out) == Counter([(1, ""), (2, ""), (3, "a"), (3, "a"), (None, "b")])


def test_tree_matching_aligns_like_nodes():
    a, _ = html_wrapper.shape_of(html_wrapper.blocks_of(html_wrapper.parse("<div><p>1</p></div><ul><li>2</li></ul>")))
    b, _ = html_wrapper.shape_of(html_wrapper.blocks_of(html_wrapper.parse("<h1>0</h1><div><p>3</p></div><ul><li>4</li></ul>")))
    assert sorted(x.tag for x, _ in html_wrapper.match_trees(a, b)) == ["#root", "div", "li", "p", "ul"]


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "content-with-sidebar", "sticky-nav", "search-results", "no-comments", "sidebar", "widget"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_of_wrappers_keep_the_article(name, tag):
    pages = [f"<body><div class='menu'>Home {k}</div><div class='{name}'><{tag}><h1>Title {k}</h1><p>Text of page {k}<div class='ad'>buy {k}</div></{tag}></div><div id='sidebar'>other {k}</div>" for k in range(5)]
    assert html_wrapper.extract(pages) == [f"Title {k}\nText of page {k}" for k in range(5)]


def test_comments_beside_an_article_never_count():
    page = "<body><article><p>Short</p><div class='comments'><p>a much longer comment than the text</p></div></article><div class='related'><article>A teaser of another page</article></div>"
    assert html_wrapper.extract([page]) == ["Short"]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_texts_that_all_articles_share_stay(tag):
    bar = "<p>Welcome to our site</p>"
    pages = [f"<body>{bar}<{tag}><h2>Summary</h2><h1>Title {k}</h1><p>By the editors</p><p>Body {k}</p><div class='ad'>buy</div><p>All rights of the reader apply here.</p></{tag}>{bar}" for k in range(6)]
    want = [f"Summary\nTitle {k}\nBy the editors\nBody {k}\nAll rights of the reader apply here." for k in range(6)]
    assert html_wrapper.extract(pages) == want == [html_wrapper.extract([p.replace(bar, "")])[0] for p in pages]


def test_shared_texts_between_slots_stay():
    pages = [f"<body><div><p>Welcome to our site</p></div><div><p>More of us</p><h1>Title {k}</h1><h2>Summary</h2><p>Body of the page {k}</p><p>Ask us</p></div><div>Teaser {k}</div><p>End</p>" for k in range(6)]
    assert html_wrapper.extract(pages) == [f"Title {k}\nSummary\nBody of the page {k}\nTeaser {k}" for k in range(6)]


def test_an_article_without_varying_text_is_template():
    pages = [f"<body><article><p>Our best story</p></article><article><h2>News</h2><p>Story {k}</p></article>" for k in range(6)]
    assert html_wrapper.extract(pages) == [f"News\nStory {k}" for k in range(6)]


def test_many_copies_of_a_row_are_spread(spark):
    rows = [(1, "http://h/1", "<body><p>Home</p><article><p>copy</p></article>")] * 400 + [(k, f"http://h/{k}", f"<body><p>Home</p><article><p>page {k}</p></article>") for k in range(2, 402)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = Counter((r.page_id, r.text) for r in html_wrapper.main_texts(df).collect())
    assert out == Counter({(1, "copy"): 400, **{(k, f"page {k}"): 1 for k in range(2, 402)}})


def test_malformed_pages_end():
    attributes = " ".join(f'a{k}="v{k}"' for k in range(60))
    assert html_wrapper.extract([f"<p>one</p><a {attributes}", f"<p>two</p><a {attributes} b='", f"<p>x</p><a {attributes} c=\"d>three</a> it's \"so"]) == ["one", "two", "x\nthree it's \"so"]
    assert html_wrapper.extract(["<p>a</p>b <!-- c <b"]) == ["a\nb"]
    deep = [f"<body>{'<div>' * 5000}deep {k}" for k in range(3)]
    assert html_wrapper.extract(deep) == ["deep 0", "deep 1", "deep 2"]


# ---------------------------------------------------------------- quality


def _brute_counts(t):
    w = _words(t)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if _words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), dup, len(covered)


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(k, "".join(rng.choice(["a", "bé", " ", "\n", "#", "a b c ", "x\n", "\x1c", "|"]) for _ in range(rng.randint(0, 150)))) for k in range(300)]
    df = spark.createDataFrame([*rows, (500, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality_rules.quality_verdicts(df, labels).collect()}
    for k, t in [*rows, (500, None)]:
        r, want = out[k], _brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def _auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    up = (y == 1).sum()
    return (rank[y == 1].sum() - up * (up + 1) / 2) / max(1, up * (len(y) - up))


def test_classifiers_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_cnn.quality_scores(docs, labels, sample=200).join(labels, "doc_id").where("held_out").toPandas()
    assert _auc(out["score"].to_numpy(), out["quality"].to_numpy()) > 0.9
    assert set(out["predicted"]) <= {0, 1} and out["score"].between(0, 1).all()
    rules = quality_rules.quality_verdicts(docs, labels).join(labels, "doc_id").toPandas()
    assert rules[(rules["quality"] == 1) & ~rules["base_failed"]]["kept"].mean() > 0.97
    assert rules[rules["quality"] == 0]["kept"].mean() < 0.2
    left = quality_rules.drop_rejected(docs, labels)
    assert left.schema == docs.schema and left.count() == quality_rules.quality_verdicts(docs, labels).where("kept").count()


def test_repeated_ids_are_one_training_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "fit", lambda x, y, **_: seen.append(len(x)) or (np.zeros(x.shape[1], np.float32), 0.0))
    docs = spark.createDataFrame([(k, f"text of {k}") for k in range(20)] + [(3, f"again {k}") for k in range(200)] + [(4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    quality_rules.train(docs, labels, sample=10)
    assert seen == [8]  # ten ids, of which a fifth calibrates


def test_network_reads_whole_texts():
    rng = np.random.default_rng(0)
    tables = rng.normal(size=(quality_cnn.WIDTH, 256, 3)).astype(np.float32)
    for size in (0, 1, 3, 4, 255, 256, 257, 900, 70_000):
        data = rng.integers(0, 256, size).astype(np.uint8)
        chunks = quality_cnn.pooled(data, tables)
        body = np.concatenate([data, np.zeros(max(quality_cnn.WIDTH - 1, quality_cnn.WIDTH - size), np.uint8)])
        answers = sum(tables[k][body[k : len(body) - quality_cnn.WIDTH + 1 + k]] for k in range(quality_cnn.WIDTH))
        assert np.allclose(chunks.max(0), answers.max(0), atol=1e-5)
        assert quality_cnn.chunk_starts(size)[-1] + quality_cnn.CHUNK >= size


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    out = quality_cnn.quality_scores(_edge(spark), labels).collect()
    assert len(out) == 9 and all(r.score == 1 and r.predicted == 1 for r in out)
    assert {r.doc_id: r.held_out for r in out}[1] == (zlib.crc32(b"1") % 5 == 0)
    assert quality_cnn.quality_scores(_edge(spark).limit(0), labels).collect() == []
    assert Counter(r.doc_id for r in quality_rules.quality_verdicts(_edge(spark), labels).collect())[6] == 2
    assert quality_rules.drop_rejected(_edge(spark), labels).columns == ["doc_id", "text", "id", "n", "base"]


# ---------------------------------------------------------------- secrets


def _brute_spans(t):
    assign = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


RANDOM_TOKEN = "9fK2LmQ7xZ4bT1vR8nW3yC6dJ5hS0aGe"


def test_training_takes_long_texts_and_repeated_ids(spark):
    free = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    word = {0: "junk%% ", 1: "kind words "}
    rows = [(i, word[k % 2] * 3000) for k, i in enumerate(free)]  # all over FIT_BYTES
    docs = spark.createDataFrame(rows + [rows[0]] * 3000, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(free)], "doc_id long, quality int")
    model = quality_cnn.train(docs, labels, sample=40)
    assert model is not None
    score = {k: quality_cnn.score(np.frombuffer((word[k] * 900).encode(), np.uint8), model) for k in (0, 1)}
    assert score[0] < 0.2 and score[1] > 0.8
    again = quality_cnn.train(docs.repartition(5), labels, sample=40)
    assert all((model[k] == again[k]).all() for k in model)


def test_bytes_of_a_long_text_are_spread():
    text = bytes(range(256)) * 400
    got = quality_cnn.spread_bytes(text, 2560)
    assert len(got) == 2560 and got[:256] == text[:256] and got[-256:] == text[-256:] and quality_cnn.spread_bytes(b"abc", 2560) == b"abc"


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(8)
    bits = ["token", "Secret", "api_key", "APIKEY", "=", ": ", "\"", "'", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "deadbeef", "é😀", " ", "x", "zz/", RANDOM_TOKEN, "passwd", "ſecret"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(500)]
    out = {r.doc_id: r for r in secret_scan.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        spans, r = _brute_spans(t), out[k]
        named = ",".join(f"{secret_scan.KINDS[j]}:{a}:{b}" for a, j, b in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(j == x for _, j, _ in spans) for x in range(3)]
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("random")) == named


WORDS = ("account address balance batch buffer cache channel client cluster column commit config context counter cursor default delete document duration element engine entry error event export "
         "factory field filter format frame gateway handler header image index input instance invoice journal kernel language layer ledger length level listener logger manager mapping message method "
         "metric model module network number object option order output package parser partition password payment pipeline pointer policy process profile project provider query queue record region "
         "request response result router schema session signal source status storage stream string summary system table target template thread timeout update user value vector version warehouse widget worker").split()


def _identifier(rng):
    words = [rng.choice(WORDS) for _ in range(rng.randint(3, 6))]
    number = rng.choice(["", "2", "17", "v2", "2024", "20240131", "001"])
    styles = ["_".join(words), "-".join(words), "".join(words), "".join(w.title() for w in words), "".join(words).upper(), "_".join(words).upper(), "/".join(words),
              words[0] + "".join(w.title() for w in words[1:]), "/".join(f"{w}{rng.randint(0, 99)}" for w in words), "_".join([words[0], str(rng.randint(1, 9999)), *words[1:]])]
    return rng.choice(styles) + number


TOKENS = {"base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
          "base64 for addresses": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", "base58": "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
          "hex, capitals": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base32, small": "abcdefghijklmnopqrstuvwxyz234567", "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
          "base36, capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}


def found_shares(spark, each=100, identifiers=6000):
    """The share of random tokens found by (kind, length) and of identifiers taken for random, and those identifiers."""
    rng = random.Random(88)
    rows, what = [], {}
    for kind, alphabet in TOKENS.items():
        for n in (20, 24, 32, 40, 64):
            for _ in range(each):
                what[len(rows)] = (kind, n)
                rows.append((len(rows), "x " + "".join(rng.choice(alphabet) for _ in range(n)) + " y"))
    while identifiers:
        name = _identifier(rng)
        if len(name) >= 20:
            identifiers -= 1
            what[len(rows)] = "identifier"
            rows.append((len(rows), f"x {name} y"))
    out = {r.doc_id: r.spans for r in secret_scan.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    total, found, wrong = Counter(what.values()), Counter(), []
    for k, t in rows:
        whole = f":2:{len(t) - 2}"
        if any(x.endswith(whole) for x in out[k].split(",")) or (what[k] != "identifier" and out[k].startswith(("hex:", "access:"))):
            found[what[k]] += 1
            if what[k] == "identifier":
                wrong.append(t)
    return {k: found[k] / n for k, n in total.items()}, wrong


def test_recall_by_kind_and_length(spark):
    shares, wrong = found_shares(spark)
    flagged = shares.pop("identifier")
    assert min(shares.values()) >= 0.9, shares
    assert flagged <= 0.01, wrong[:20]


def test_battery_finds_random_tokens_only(spark):
    rows = [(1, f"see {RANDOM_TOKEN} ok"), (2, "a/quite/ordinary/path/with/words2 or long_identifier_name_of_version1"), (3, "2222222222222222222222222222aaaaaaaaaaaaaaaa"), (4, "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B")]
    out = {r.doc_id: r.spans for r in secret_scan.secret_spans(spark.createDataFrame(rows * 5, "doc_id long, text string")).collect()}
    assert out == {1: f"random:4:{4 + len(RANDOM_TOKEN)}", 2: "", 3: "hex:0:44", 4: "random:0:40"}


def test_tokens_behind_an_equals_sign(spark):
    other = "Zk3QvX8mB1tYc7RfLw5NsJ0hGd2UeP9a"
    texts = ["AWS_SECRET_ACCESS_KEY={}", "export GITHUB_PAT={}\nPATH=/usr/bin", "https://h.example/a?sig={}&page=2", "https://h.example/?user=me&key={}", "A_LONG_NAME_OF_A_VARIABLE={}", "x=={} y", "see {}== ok", "={}"]
    rows = [(k, t.format(token)) for token in (RANDOM_TOKEN, other) for k, t in enumerate(texts, 100 * (token == other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secret_scan.secret_spans(df).collect()}
    for k, t in enumerate(texts):
        a = t.index("{}")
        assert spans[k] == spans[100 + k] == f"random:{a}:{a + 32 + 2 * ('}==' in t)}"
    left = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert left == {k: texts[k % 100].replace("{}==", "{}").format("[SECRET]") for k in left}


def test_redaction_and_edges(spark):
    rows = [(1, f"a password=abcdef12 b {RANDOM_TOKEN}", "x"), (2, None, "x"), (3, "", "x"), (4, "token=" + "0123456789abcdef" * 2 + "é", "x"), (5, "clean text", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, secret_base string")
    out = secret_scan.redact(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a [SECRET] b [SECRET]", 2: None, 3: "", 4: "[SECRET]é", 5: "clean text"}
    assert secret_scan.secret_spans(_edge(spark).limit(0)).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r.base_sha256, r.spans) == (nothing, "") for r in secret_scan.secret_spans(_edge(spark)).collect())


def test_secret_scan_is_native(spark):
    plan = secret_scan.redact(_edge(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- helpers


def test_blocks_and_words():
    data, off = textops.byte_view(__import__("pyarrow").array(["a b", None, "", " c\td ", "x" * 50]))
    assert off.tolist() == [0, 3, 3, 3, 8, 58]
    s, e, w = textops.word_bounds(data, off)
    assert [bytes(data[a:b]).decode() for a, b in zip(s, e)] == ["a", "b", "c", "d", "x" * 50] and w.tolist() == [0, 2, 2, 2, 4, 5]
    assert list(textops.blocks(off, 8)) == [(0, 4), (4, 5)] and list(textops.blocks(off, 8, 2)) == [(0, 2), (2, 4), (4, 5)]
