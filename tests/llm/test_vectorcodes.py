"""Vector codes against brute force; curve, boxes, exact kernels, odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<double>, label int, rid int, codes string, Error long, q int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """{position in rows: (codes, error)} and the codebooks, all pairs compared with Python integers."""
    kept = [(i, r[0], [math.floor(scale * x) for x in r[1]]) for i, r in enumerate(rows)
            if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, []
    width = len(kept[0][2]) // parts
    first = sorted(kept, key=lambda k: (k[1] is None, k[1] or 0, k[2]))[:entries]
    cut = lambda q, p: q[p * width:(p + 1) * width]
    books = [[cut(q, p) for _, _, q in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, book: min((dist(v, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            won = {}
            for _, _, q in kept:
                won.setdefault(best(cut(q, p), books[p])[1], []).append(cut(q, p))
            for e, vs in won.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    out = {}
    for i, _, q in kept:
        found = [best(cut(q, p), books[p]) for p in range(parts)]
        out[i] = ([e for _, e in found], sum(d for d, _ in found))
    return out, books


def run(spark, rows, **more):
    df = spark.createDataFrame([(r[0], r[1], r[2], i, "c", 7, 8) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    coded = vectorcodes.encode(df, {"at": F.col("rid"), "label": F.col("label")}, **more)
    return {r["at"]: (list(r["codes"]), r["error"]) for r in coded.rows.collect()}, [b.tolist() for b in coded.codebooks], coded


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(8)
    centres = [[pick.gauss(0, 0.2) for _ in range(8)] for _ in range(6)]
    out = [(pick.randrange(300), [c + pick.gauss(0, 0.05) for c in pick.choice(centres)], pick.choice([1, 2, None])) for _ in range(200)]
    out += [(5, [0.1] * 8, 1)] * 60 + [(None, [-0.3] * 8, 2), (None, [-0.3] * 8, 2)]
    return out + [(1, None, 1), (2, [], 1), (3, [0.1] * 7 + [None], 1), (4, [0.1] * 7 + [float("nan")], 1), (6, [float("inf")] * 8, 1)]


@pytest.mark.parametrize("entries,block", [(256, 256), (16, 8), (3, 1)])
def test_equals_brute_force(spark, rows, entries, block):
    got, books, _ = run(spark, rows, entries=entries, block=block)
    want, want_books = brute(rows, entries=entries)
    assert got == want and books == want_books


def test_large_components_stay_exact(spark):
    pick = random.Random(2)
    rows = [(i, [pick.uniform(-16000, 16000) for _ in range(8)], None) for i in range(60)]
    got, books, _ = run(spark, rows, entries=7, block=16)
    assert (got, books) == brute(rows, entries=7)


def test_labels_digest_and_empty_tables(spark, rows):
    _, _, coded = run(spark, rows, entries=16)
    sums = {}
    for r in coded.rows.collect():
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    got = vectorcodes.error_by(coded.rows, "label").collect()
    assert len(got) == coded.rows.count() and all(r["label_error"] == sums[r["label"]] for r in got)
    assert len(coded.digest()) == 64
    for none in ([], [(1, None, 1), (2, [], None)]):
        assert run(spark, none)[:2] == ({}, [])


def test_refused_shapes(spark):
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 4, 1)], [(1, [0.0] * 6, 1)], [(1, [1e300] * 8, 1)]):
        with pytest.raises(ValueError):
            run(spark, bad)


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_cell_in_unit_steps(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
    order = np.argsort(vectorcodes.hilbert_keys(cells, bits))
    assert sorted(vectorcodes.hilbert_keys(cells, bits).tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_shortlists_never_lose_a_nearest_entry():
    pick = np.random.default_rng(1)
    for _ in range(200):
        points, book = pick.integers(-6, 6, (5, 3)), pick.integers(-6, 6, (9, 3))
        few = np.flatnonzero(vectorcodes.shortlist(points.min(0)[None], points.max(0)[None], book)[0])
        want = [min(range(9), key=lambda e: (((p - book[e]) ** 2).sum(), e)) for p in points]
        at, error = vectorcodes.nearest(points, book[few])
        assert few[at].tolist() == want and error.tolist() == [int(((p - book[e]) ** 2).sum()) for p, e in zip(points, want)]
