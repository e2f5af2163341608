"""Vector code compression: the search against all entries, the codes against plain Python, and edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from blotter.llm import vector_codes as vc

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("seed,k,spread", [(1, 16, 5), (2, 16, 4000), (3, 1, 9), (4, 40, 2)])
def test_orchard_finds_the_nearest_entry(seed, k, spread):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-spread, spread, (700, 3)), rng.integers(-spread, spread, (k, 3))
    if k > 3:
        c[3] = c[1]  # equal entries: the lower index
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    for scale in (1, 1 << 45):
        best, near = vc.orchard(x * scale, c * scale)
        assert (best == d.argmin(1)).all() and [int(v) for v in near] == [int(v) * scale**2 for v in d.min(1)]


def test_orchard_measures_fewer_entries():
    rng = np.random.default_rng(0)
    c = rng.integers(-1000, 1000, (16, 2))
    measured = 0

    class Counted(np.ndarray):
        def __getitem__(self, at):
            nonlocal measured
            if isinstance(at, np.ndarray) and self.ndim == 2 and self.shape[0] == 4000:
                measured += len(at)
            return np.asarray(self)[at]

    x = (c[rng.integers(0, 16, 4000)] + rng.integers(-20, 20, (4000, 2))).view(Counted)
    x.astype = lambda kind: x
    vc.orchard(x, c)
    assert 0 < measured < 0.8 * 15 * 4000


def _brute(rows, parts=8, entries=16, rounds=6):
    """(id, label, v) rows -> the contract's rows, in plain integers."""
    rows = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    rows = [(i, k, [math.floor(4096 * x) for x in v]) for i, k, v in rows]
    width = len(rows[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in rows]
    first = sorted(range(len(rows)), key=lambda r: rows[r][0])[:entries]
    books = [[list(cut[r][p]) for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for row in cut:
                got.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            for e, xs in got.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    out, by_label = {}, {}
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    for (i, label, _), row in zip(rows, cut):
        found = [nearest(row[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out[i] = (label, "".join(f"{e:02x}" for _, e in found), error)
    return {i: (code, error, by_label[label], sha) for i, (label, code, error) in out.items()}


def _frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, k, "x", 0) for i, k, v in rows], f"vec_id long, embedding array<{kind}>, label int, code string, part int")


def _got(df):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()}


@pytest.mark.parametrize("kind,n,dims", [("float", 300, 16), ("double", 11, 8), ("double", 60, 24)])
def test_codes_equal_plain_python(spark, kind, n, dims):
    rng = random.Random(n)
    f = (lambda x: float(np.float32(x))) if kind == "float" else float
    rows = [(1000 - 3 * k, rng.choice([None, 0, 1, 2]), [f(rng.gauss(rng.choice([-1, 0, 2]), 0.4)) for _ in range(dims)]) for k in range(n)]
    rows += [(5000, 1, rows[0][2]), (-7, 0, rows[1][2])]  # equal vectors
    bad = [(-99, 1, None), (-98, 1, [None] + [0.0] * (dims - 1)), (-97, None, [NAN] * dims), (-96, 2, [0.5] * (dims - 1) + [-INF])]
    want = _brute(rows + bad)
    assert _got(vc.compressed(_frame(spark, rows + bad, kind).repartition(4))) == want and len(want) == n + 2


def test_huge_components_stay_exact(spark):
    def held(rows):  # what no long holds is null
        return {i: (c, e if e < 2**63 else None, s if s < 2**63 else None, sha) for i, (c, e, s, sha) in _brute(rows).items()}

    rows = [(k, k % 2, [float(k * 2**20 + p) for p in range(8)]) for k in range(17)]
    assert _got(vc.compressed(_frame(spark, rows, "double"))) == held(rows)
    rows = [(k, 0, [float(k * 2**34 + p) for p in range(8)]) for k in range(40)]
    assert _got(vc.compressed(_frame(spark, rows, "double"))) == held(rows)
    top = [(k, 0, [1e300 if k % 2 else -1e300] * 8) for k in range(20)]  # errors and sums beyond a long are null, codes are not
    got = _got(vc.compressed(_frame(spark, top, "double")))
    assert {v[0] for v in got.values()} == {"00" * 8, "01" * 8} and all(v[1] == 0 for v in got.values())
    far = _got(vc.compressed(_frame(spark, [(0, 0, [0.0] * 8), (None, 0, [1e18] * 8)], "double"), rounds=0))
    assert far[None][:3] == ("00" * 8, None, None)


def test_edge_cases(spark):
    empty = vc.compressed(_frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = _got(vc.compressed(_frame(spark, [(None, 1, [1.0] * 8), (None, 1, None), (None, 2, [])])))
    assert got == {None: (None, None, None, hashlib.sha256(b"").hexdigest())}
    odd = vc.compressed(_frame(spark, [(1, 0, [0.5] * 9), (2, 0, [0.25] * 9), (2, 0, [0.125] * 9), (3, 0, [1.0] * 8), (4, 0, []), (None, 0, [0.5] * 9)]))
    rows = sorted(odd.collect(), key=str)
    assert {r.vec_id for r in rows} == {1, 2, 3, 4, None} and len(rows) == 6
    assert all((r.code is None) == (r.error is None) == (r.vec_id in (3, 4)) and r.label_error is not None for r in rows)
    assert {r.code for r in rows if r.vec_id in (1, None)} == {"00" * 8}  # two ids, so two entries; the smaller vector of id 2 starts one


def test_decode_gives_the_entries_back(spark):
    rng = random.Random(4)
    rows = [(k, 0, [rng.gauss(0, 1) for _ in range(20)]) for k in range(120)]
    df = _frame(spark, rows, "double")
    length, books = vc.train(df)
    coded = vc.decode(vc.encode(df, length, books), length, books)
    by_id = {i: v for i, _, v in rows}
    for r in coded.collect():
        whole = [math.floor(4096 * x) for x in by_id[r.id]]
        assert len(r.approx) == 20 and r.error == sum((a - round(4096 * b)) ** 2 for a, b in zip(whole, r.approx))
    unknown = spark.createDataFrame([(1, "ff" * 8), (2, None), (3, "00"), (4, "zz" * 8)], "id long, code string")
    assert [r.approx for r in vc.decode(unknown, length, books).collect()] == [None] * 4
