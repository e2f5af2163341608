"""Language identification against a plain version, held-out accuracy, and edge cases."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import rank_profiles as rp
from blotter.llm.shared import table

SMALL = "/root/testdata/sf0.001"


def _grams(text):
    out = Counter()
    for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" "):
        if w:
            w = f" {w} "
            out.update(w[k : k + n] for n in (1, 2, 3) for k in range(len(w) - n + 1) if w[k : k + n] != " ")
    return out


def _profile(counts):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[: rp.TOP]


def _brute(rows):
    langs = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            langs.setdefault(lang, Counter()).update(_grams(text))
    ranks = {k: {g: r for r, g in enumerate(_profile(v))} for k, v in langs.items() if v}
    out = []
    for i, text, _ in rows:
        own = _profile(_grams(text))
        if not own or not ranks:
            out.append((i, "und", 0.0))
            continue
        far = {k: sum(abs(r - rank[g]) if g in rank else rp.TOP for r, g in enumerate(own)) for k, rank in ranks.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((i, best, 1 - far[best] / (rp.TOP * len(own))))
    return sorted(out, key=str)


def _got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n int, gram string")
    return sorted(((r.doc_id, r.lang_pred, r.score) for r in rp.languages(df.repartition(3)).collect()), key=str)


def test_predictions_equal_a_plain_version(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, SMALL, "documents").collect()]
    assert _got(spark, rows) == _brute(rows)


def test_held_out_rows_are_told_apart(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = rp.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert total > 250 and right / total >= 0.98
    assert {r.doc_id for r in got.select("doc_id").collect()} == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}


def test_language_of_held_out_rows_is_never_read(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, SMALL, "documents").collect()]
    hidden = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else k) for i, t, k in rows]
    assert _got(spark, rows) == _got(spark, hidden)


def test_edge_cases(spark):
    rows = [(0, "the cat sat on the mat", "en"), (3, "der hund und die katze", "de"), (3, "der hund und die katze", "de"), (None, "le chat", "fr"), (5, "le chien", None), (6, None, "en"), (7, "", "en"),
            (8, " 123 \t ?!", "xx"), (9, "中文 текст ÄÖ ŉ ẞ 😀 ² x́y", "mixed"), (10, "a", None), (11, "the cat_and2the dog\n" * 80_000, "en")]
    got = _got(spark, rows)
    assert got == _brute(rows)
    assert {r[0] for r in got if r[1] == "und"} == {6, 7, 8} and all(0 <= r[2] <= 1 for r in got)
    assert _got(spark, []) == [] and {r[1:] for r in _got(spark, [(1, "no language here", None)])} == {("und", 0.0)}


def test_ties_go_to_the_smaller_name(spark):
    free = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(free[0], "same words", "b"), (free[1], "same words", "a"), (free[2], "same", None)]
    assert {r[1] for r in _got(spark, rows)} == {"a"}


@pytest.mark.parametrize("piece", [1, 10, 1 << 20])
def test_a_text_read_in_pieces_counts_the_same(monkeypatch, piece):
    text = "Été in Σας; x2y  über\nΟΔΟΣ. " * 9
    monkeypatch.setattr(rp, "PIECE", piece)
    g, n = rp.counted(text)
    want = _grams(text)
    names = ["".join(chr(x >> 42 & 0x1FFFFF) + chr(x >> 21 & 0x1FFFFF) + chr(x & 0x1FFFFF)).lstrip("\0") for x in g.tolist()]
    assert dict(zip(names, n.tolist())) == want and (np.diff(g) > 0).all()
