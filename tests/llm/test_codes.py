import hashlib
import math
import random

import numpy as np
import pytest
from oracle_harness import compare
from pyspark.sql import functions as F

from tallyspark.llm import codes, queries

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, entries=64, rounds=2, parts=16):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0], r[1]))
    w = len(good[0][1]) // parts
    cut = [[r[1][p * w : (p + 1) * w] for p in range(parts)] for r in good]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[0], []).append(c[p])
            new.append([[sum(col) // len(groups[e]) for col in zip(*groups[e], strict=True)] if e in groups else books[p][e] for e in range(len(books[p]))])
        books = new
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for _, d in f) for f in found]
    by_label = {}
    for (_, _, lab), e in zip(good, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(str((i, "".join(f"{k:02x}" for k, _ in f), e, by_label[lab], digest)) for (i, _, lab), f, e in zip(good, found, error, strict=True))


def vectors(n, width, seed, spread=0.4):
    rnd = random.Random(seed)
    rows = [(k * 3 % n, [rnd.gauss(0, spread) for _ in range(16 * width)], rnd.choice([None, 1, 1, 1, 2])) for k in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [float("nan")] * 16 * width, 1), (n + 3, [None] + [0.1] * (16 * width - 1), 2), (n + 4, [float("inf")] + [0.1] * (16 * width - 1), 2)]
    rows += [(n + 5, [0.25] * 16 * width, None), (n + 5, [0.25] * 16 * width, None), (n + 6, [-1.0 / 256] * 16 * width, 7)]
    rnd.shuffle(rows)
    return rows


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, COLUMNS).withColumns({"v": F.lit("clash"), "code": F.lit(1), "a.b": F.lit(2), "_l": F.lit(3)})
    return sorted(str(tuple(r)) for r in codes.codes(df, **how).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize(("n", "width", "entries", "rounds"), [(300, 4, 64, 2), (20, 2, 64, 2), (90, 1, 8, 3), (80, 3, 64, 0)])
def test_equals_brute_force(spark, n, width, entries, rounds):
    rows = vectors(n, width, n)
    assert got(spark, rows, entries=entries, rounds=rounds) == brute_codes(rows, entries, rounds)


def test_cell_size_changes_no_result(spark):
    rows = vectors(200, 4, 1, 0.1)
    want = got(spark, rows)
    assert all(got(spark, rows, cell=c) == want for c in (1, 7, 1000))


@pytest.mark.parametrize("seed", range(5))
def test_grid_cells_find_the_lowest_nearest_entry(seed):
    rnd = np.random.default_rng(seed)
    entries = rnd.integers(-40, 40, size=(64, 3))
    entries[40:44] = entries[3]  # equal entries: the lowest index wins
    grid = codes.GridCells(entries, cell=8, cells=60)
    for _ in range(6):  # the memory starts anew in between
        x = rnd.integers(-60, 60, size=(400, 3))
        d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        index, least = grid.nearest(x)
        assert (index == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert grid.evaluated < 6 * 400 * 64 / 2 and len(grid.candidates) == len(grid.known)


def test_ties_between_entries(spark):
    rows = [(k, [float(x)] * 16, 1) for k, x in enumerate([0, 2, 1, 1, 0, 2, 3])]
    assert got(spark, rows, entries=2, rounds=1) == brute_codes(rows, 2, 1)


def test_lengths_that_do_not_fit_and_empty_tables(spark):
    rows = [(1, [0.5] * 32, 1), (2, [0.5] * 16, 1), (3, [0.5] * 17, 1), (4, [], 1), (5, [0.25] * 32, None)]
    assert [r.split(",")[0] for r in got(spark, rows)] == ["(1", "(5"]
    assert got(spark, []) == [] and got(spark, rows[2:4]) == []
    with pytest.raises(Exception, match="a component is larger"):
        got(spark, [(1, [3e30] * 16, 1)])


def test_matches_sql(spark, con, sf_dir):
    ok, msg = compare(queries.op13_vector_codes(spark, sf_dir), con, codes.SQL)
    assert ok, msg
