"""Spelling variant grouping against all pairs, and on edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from blotter.llm import spelling_groups as sg


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def _brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if _near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def _got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")


@pytest.mark.parametrize("seed", [1, 2])
def test_words_forms_and_roots_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(6, 13))) for _ in range(25)]
    bases += ["".join(rng.choice(["th", "er", "on"]) for _ in range(rng.randrange(3, 6))) for _ in range(40)]  # anagrams
    many = []
    for w in bases:
        size = 1
        for _ in range(4):  # chains: each form five and more times as frequent as the one before
            many += [w] * (rng.choice([5, 6, 7]) * size)
            size *= 6
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abxÿ") + w[k + 1 :]])
            if len(many) > 60_000:
                break
    rng.shuffle(many)
    rows = [(k, " ".join(w.upper() if w.isascii() and rng.random() < 0.1 else w for w in many[k::50])) for k in range(50)]
    got = _got(sg.spelling_groups(_docs(spark, rows).repartition(3)))
    assert got == _brute(rows)
    assert any(v[0] and v[0] != v[1] for v in got.values()) and any(v[3] > 1 for v in got.values())


def test_every_edit_shares_a_signature():
    rng = random.Random(5)
    for _ in range(3000):
        w = "".join(rng.choice("abcdé" if rng.random() < 0.5 else "abcdefghijklmnopqrstuvwxyzàéü") for _ in range(rng.randrange(6, 16)))
        k, c = rng.randrange(len(w) + 1), rng.choice("abzé")
        v = rng.choice([w[:k] + c + w[k:], w[: k - 1] + c + w[k:] if k else w, w[: k - 1] + w[k:] if k and len(w) > 6 else w])
        assert set(sg.signatures(w)) & set(sg.signatures(v)), (w, v)


def test_nulls_repeats_long_texts_and_empty_tables(spark):
    long_text = "letter\n" * 200_000 + "lettér-" * 30 + "x" * (1 << 20) + " latter" * 40
    rows = [(1, None), (2, ""), (3, "  \t12 5"), (None, "Letter lettre " * 6), (4, "colour " * 30), (4, "colour " * 30), (5, "color color " * 3), (6, long_text)]
    got = _got(sg.spelling_groups(_docs(spark, rows)))
    want = _brute(rows)
    assert got == want and got["letter"][2] > 100_000 and got["latter"][0] == got["lettér"][0] == "letter" and got["colour"][2] == 60
    assert sg.spelling_groups(_docs(spark, rows[:3])).collect() == []
    empty = sg.spelling_groups(_docs(spark, []))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_a_text_read_in_pieces_counts_the_same(monkeypatch):
    text = "".join(random.Random(3).choice(["abc", "é", " ", "\n", "7", "Xyz", "½"]) for _ in range(5000))
    whole = sg._run_counts(text)
    monkeypatch.setattr(sg, "PIECE", 7)
    assert sg._run_counts(text) == whole == Counter(w.translate(sg._FOLD) for w in re.findall("[A-Za-zÀ-ÿ]+", text))


def test_roots_of_a_long_chain(spark):
    rows = [(f"w{k}", f"w{k + 1}") for k in range(21)] + [("a", "w3"), ("b", "c")]
    got = {r.word: r.root for r in sg.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {**{f"w{k}": "w21" for k in range(21)}, "a": "w21", "b": "c"}
