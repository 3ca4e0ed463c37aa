"""The epsilon grid order join against all pairs, in one tile and in many, with what is skipped counted."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from beatlake.llm import vectors


def brute(rows, cosine=0.9):
    """{place: (links, component)} by looking at every pair; rows are (vec_id, vector or None)."""
    directions = []
    for _, vector in rows:
        array = None if not vector or any(x is None for x in vector) else np.array(vector, dtype=np.float64)
        usable = array is not None and np.isfinite(array).all() and array.any()
        directions.append(array / np.linalg.norm(array / np.abs(array).max()) / np.abs(array).max() if usable else None)
    links = [[] for _ in rows]
    for size in {len(x) for x in directions if x is not None}:
        places = [at for at, x in enumerate(directions) if x is not None and len(x) == size]
        found = np.array([directions[at] for at in places])
        for row, column in zip(*np.nonzero(found @ found.T >= cosine)):
            if row != column:
                links[places[row]].append(places[column])
    component = {}
    for at in range(len(rows)):
        if at not in component:
            group, front = {at}, [at]
            while front:
                new = set(links[front.pop()]) - group
                group |= new
                front += new
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            component |= dict.fromkeys(group, min(ids) if ids else None)
    return [(rows[at][0], len(links[at]), component[at], rows[at][0] == component[at]) for at in range(len(rows))]


def made_up(seed, size=12, kind=float):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, size))
    rows = [(n, list(map(kind, random.normal(size=size)))) for n in range(150)]
    for n in range(150, 420):
        rows.append((n, list(map(kind, centres[n % 6] + random.normal(size=size) * random.choice([0.1, 0.3, 0.45])))))
    rows += [(n, rows[150 + n % 9][1]) for n in range(420, 470)]  # exact copies
    rows += [(n, [x * 7.5 for x in rows[150 + n % 9][1]]) for n in range(470, 480)]  # of another length
    rows += [(-3, rows[151][1]), (-3, rows[151][1]), (None, rows[152][1]), (None, rows[3][1])]
    rows += [(600, None), (601, []), (602, [0.0] * size), (603, [float("nan")] * size), (604, [None, *rows[0][1][1:]])]
    rows += [(605, [float("inf")] * size), (606, rows[0][1][:5]), (607, rows[0][1][:5]), (608, [-0.0, 1.0]), (609, [0.0, 1.0])]
    return rows


def rows_of(frame):
    return sorted(map(tuple, frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize(("element", "block", "tile"), [("float", 512, None), ("double", 16, 40), ("double", 7, 7)])
def test_join_equals_all_pairs(spark, element, block, tile):
    rows = made_up(block, kind=np.float32 if element == "float" else float)
    rows = [(key, None if vector is None else [None if x is None else float(x) for x in vector]) for key, vector in rows]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>")
    frame = frame.withColumns({"name": F.lit(1), "n": F.lit("x"), "label": F.lit(2)}).repartition(5)
    wanted = brute([(key, vector and [np.float32(x) if element == "float" and x is not None else x for x in vector]) for key, vector in rows])
    assert rows_of(vectors.near_duplicates(frame, block_rows=block, tile_rows=tile)) == sorted(wanted, key=repr)


def test_given_vectors_with_copies(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(row.vec_id, row.embedding) for row in given.collect()]
    random = np.random.default_rng(1)
    for n in range(300):
        vector = np.array(rows[n % 40][1], dtype=np.float32)
        near = vector + random.normal(size=len(vector)).astype(np.float32) * np.float32(0.06 * np.linalg.norm(vector) / 2)
        rows.append((10_000 + n, [float(x) for x in near]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wanted = sorted(brute([(key, np.array(vector, dtype=np.float32).tolist()) for key, vector in rows]), key=repr)
    assert rows_of(vectors.near_duplicates(frame)) == wanted and sum(row[1] > 0 for row in wanted) > 200


def test_large_and_small_components(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1.0, 0.0]), (4, [5e-324, 5e-324])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [row[:3] for row in rows_of(vectors.near_duplicates(frame))] == [(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1)]


def test_no_vectors(spark):
    frame = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    assert rows_of(vectors.near_duplicates(frame)) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


@given(st.integers(0, 2**31), st.integers(2, 40))
@settings(max_examples=60, deadline=None)
def test_boxes_never_hide_a_link(seed, size):
    random = np.random.default_rng(seed)
    one = random.normal(size=(20, size)) * random.uniform(0.01, 1, size=size)
    other = one + random.normal(size=one.shape) * 0.2 * np.abs(one).mean()
    data = [np.ascontiguousarray(x).tobytes() for x in (one, other)]
    units = [vectors.units(x, size, "<f8") for x in data]
    axes = vectors.directions(np.concatenate(units))
    spots = [vectors.coordinates(x, axes) for x in units]
    for row in range(20):
        for column in range(20):
            if units[0][row] @ units[1][column] >= vectors.COSINE:
                gap = vectors.apart(spots[0][row], spots[0][row], spots[1][column], spots[1][column])
                assert gap <= 2 - 2 * vectors.COSINE + vectors.SLACK


def test_distant_intervals_are_skipped():
    """Clusters on a low-dimensional surface: most pairs of blocks are skipped, and no link is."""
    random = np.random.default_rng(4)
    angles = np.sort(random.uniform(0, 2 * np.pi, 4096))
    points = np.column_stack([np.cos(angles), np.sin(angles), 0.01 * random.normal(size=(4096, 6))])
    axes = vectors.directions(points)
    order = np.lexsort(np.floor(points @ axes / np.sqrt(0.2)).T[::-1])
    blocks, join = [], vectors.TileJoin(0.9)
    for begin in range(0, 4096, 64):
        part = points[order[begin : begin + 64]]
        spots = vectors.coordinates(vectors.units(part.tobytes(), 8, "<f8"), axes)
        names, ones = np.arange(begin, begin + 64), np.ones(64, dtype=np.int64)
        blocks.append(vectors.Block(names.tobytes(), ones.tobytes(), part.tobytes(), spots.min(axis=0), spots.max(axis=0), 8, "<f8"))
        join.admit(blocks[-1])
    join.intervals(blocks, blocks)
    units = points[order] / np.linalg.norm(points[order], axis=1, keepdims=True)
    assert join.products < 64 * 65 // 2 // 2
    assert (join.links[:4096] == (units @ units.T >= 0.9).sum(axis=1) - 1).all()
