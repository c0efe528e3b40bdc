import numpy as np
import pytest
from pyspark.sql import functions as F

from unitgrid.operators import regions as R


def masks(spark, grids):
    rows = [(f"i{k}", int(r), int(c)) for k, g in enumerate(grids) for r, c in zip(*np.nonzero(g))]
    return spark.createDataFrame(rows, "image_id string, row long, col long")


def grids_of(df, shape, n):
    out = [np.zeros(shape, dtype=bool) for _ in range(n)]
    for r in df.select("image_id", "row", "col").collect():
        out[int(r.image_id[1:])][r.row, r.col] = True
    return out


def flood(grid, conn):
    """Component label per pixel, by flood fill."""
    label, steps = {}, [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if conn == 8 else [])
    for start in zip(*np.nonzero(grid)):
        if start in label:
            continue
        todo = [start]
        label[start] = start
        while todo:
            r, c = todo.pop()
            for dr, dc in steps:
                p = (r + dr, c + dc)
                if 0 <= p[0] < grid.shape[0] and 0 <= p[1] < grid.shape[1] and grid[p] and p not in label:
                    label[p] = start
                    todo.append(p)
    return label


def random_grids(n=6, shape=(23, 31), seed=3):
    rng = np.random.default_rng(seed)
    grids = [rng.random(shape) < p for p in np.linspace(0.35, 0.75, n - 1)]
    snake = np.zeros(shape, dtype=bool)
    snake[::2] = True
    for i, r in enumerate(range(1, shape[0] - 1, 2)):
        snake[r, -1 if i % 2 == 0 else 0] = True
    return grids + [snake]


@pytest.mark.parametrize("conn", [4, 8])
@pytest.mark.parametrize("tile", [4, 64])
def test_components_match_flood_fill(spark, conn, tile):
    grids = random_grids()
    runs = R.component_runs(masks(spark, grids), conn, tile=tile)
    got = runs.withColumn("col", F.explode(F.sequence("p0", "p1"))).collect()
    assert len(got) == sum(int(g.sum()) for g in grids)
    want = [flood(g, conn) for g in grids]
    for r in got:
        first = want[int(r.image_id[1:])][(r.line, r.col)]
        assert r.label == first[0] * R.LABEL_BASE + first[1]


def test_remove_small(spark):
    grids = random_grids(4)
    got = grids_of(R.remove_small(masks(spark, grids), 10), grids[0].shape, len(grids))
    for g, k in zip(grids, got):
        label = flood(g, 4)
        sizes = {s: list(label.values()).count(s) for s in set(label.values())}
        want = {p for p, s in label.items() if sizes[s] >= 10}
        assert set(zip(*np.nonzero(k))) == want


def brute_open(grid, length=5):
    """Erode then dilate; outside counts as set for the erosion and as clear for the dilation."""
    half = length // 2
    p = np.pad(grid, ((0, 0), (half, half)), constant_values=True)
    eroded = np.all([p[:, k:k + grid.shape[1]] for k in range(length)], axis=0)
    q = np.pad(eroded, ((0, 0), (half, half)), constant_values=False)
    return np.any([q[:, k:k + grid.shape[1]] for k in range(length)], axis=0)


def test_opening_matches_erosion_and_dilation(spark):
    grids = random_grids(6, (14, 17), 5)
    got = grids_of(R.open_lines(masks(spark, grids), 14, 17), (14, 17), len(grids))
    for g, k in zip(grids, got):
        assert np.array_equal(k, brute_open(g) | brute_open(g.T).T)


def slow_thin(grid):
    """Zhang-Suen, pixel by pixel on the whole grid."""
    g = np.pad(grid.astype(int), 1)
    while True:
        changed = False
        for step in (0, 1):
            drop = []
            for r, c in zip(*np.nonzero(g)):
                p = [g[r - 1, c], g[r - 1, c + 1], g[r, c + 1], g[r + 1, c + 1], g[r + 1, c], g[r + 1, c - 1], g[r, c - 1], g[r - 1, c - 1]]
                a = sum(p[i] == 0 and p[(i + 1) % 8] == 1 for i in range(8))
                sides = (p[0] * p[2] * p[4], p[2] * p[4] * p[6]) if step == 0 else (p[0] * p[2] * p[6], p[0] * p[4] * p[6])
                if 2 <= sum(p) <= 6 and a == 1 and sides == (0, 0):
                    drop.append((r, c))
            for r, c in drop:
                g[r, c] = 0
            changed |= bool(drop)
        if not changed:
            return g[1:-1, 1:-1].astype(bool)


@pytest.mark.parametrize("tile,passes", [(8, 1), (8, 3), (128, 16)])
def test_skeleton_is_independent_of_tiles(spark, tile, passes):
    blob = np.zeros((30, 40), dtype=bool)
    blob[3:14, 2:38] = True
    blob[14:27, 20:29] = True
    grids = [blob] + random_grids(3, (30, 40), 8)[:2]
    got = grids_of(R.skeleton(masks(spark, grids), tile=tile, passes=passes), (30, 40), len(grids))
    for g, k in zip(grids, got):
        assert np.array_equal(k, slow_thin(g))


def test_skeleton_thins_only_the_frontier_again(spark, monkeypatch):
    """A thick block far from a thin line: the line's tile is thinned in the first round only; a block that moves late wakes others."""
    grid = np.zeros((24, 64), dtype=bool)
    grid[5, 40:63] = True
    grid[2:18, 1:19] = True
    written = []
    keep = R.materialize

    def watched(df, label="step"):
        out = keep(df, label)
        if label == "thin":
            written.append(out.select("_tr", "_tc").distinct().count())
        return out
    monkeypatch.setattr(R, "materialize", watched)
    got = grids_of(R.skeleton(masks(spark, [grid]), tile=8, passes=1), grid.shape, 1)[0]
    assert np.array_equal(got, slow_thin(grid))
    assert len(written) > 3 and written[-1] < written[0] / 2


def test_skeleton_of_nothing(spark):
    assert R.skeleton(masks(spark, [])).count() == 0
    square = np.zeros((20, 20), dtype=bool)
    square[7:9, 7:9] = True   # vanishes, and crosses four tiles
    assert np.array_equal(grids_of(R.skeleton(masks(spark, [square]), tile=8, passes=1), (20, 20), 1)[0], slow_thin(square))


@pytest.mark.parametrize("tile", [4, 64])
def test_diagonal_contacts_unite_labels(spark, tile):
    grids = random_grids()
    runs = R.join_diagonals(R.component_runs(masks(spark, grids), 4, tile=tile))
    got = runs.withColumn("col", F.explode(F.sequence("p0", "p1"))).collect()
    want = [flood(g, 8) for g in grids]
    assert len(got) == sum(int(g.sum()) for g in grids)
    for r in got:
        first = want[int(r.image_id[1:])][(r.line, r.col)]
        assert r.label == first[0] * R.LABEL_BASE + first[1]


def test_water_is_tiled_once(spark, monkeypatch):
    calls = []
    tiles = R._tile_runs
    monkeypatch.setattr(R, "_tile_runs", lambda *a: calls.append(a) or tiles(*a))
    R.classify_water(masks(spark, random_grids(3)), 900.0).collect()
    assert len(calls) == 1


def test_region_props_match_pixels(spark):
    grids = random_grids(3, (20, 20), 9)
    props = R.region_props(R.component_runs(masks(spark, grids), 8, tile=8)).collect()
    pixels = {}
    for k, g in enumerate(grids):
        for p, s in flood(g, 8).items():
            pixels.setdefault((f"i{k}", *s), []).append(p)
    assert len(props) == len(pixels)
    for r in props:
        pts = np.array(pixels[(r.image_id, r.label_row, r.label_col)], dtype=float)
        assert r.area == len(pts)
        assert np.allclose([r.centre_row, r.centre_col], pts.mean(axis=0))
        ev = np.linalg.eigvalsh(np.cov(pts.T, bias=True)) if len(pts) > 1 else np.zeros(2)
        assert np.allclose([r.minor_axis, r.major_axis], 4 * np.sqrt(np.maximum(ev, 0)), atol=1e-6)


def test_water_classes(spark):
    g = np.zeros((40, 40), dtype=bool)
    g[1:5, 1:5] = True        # 16 px x 900 = 14,400 m2: natural by size
    g[10, 1:11] = True        # 10 px in a line = 9,000 m2 and long: natural
    g[20:23, 20:23] = True    # 9 px square: aquaculture
    g[30, 30:33] = True       # 3 px: dropped
    row = R.water_metrics(masks(spark, [g]), 900.0).first()
    assert (row.water_pixels, row.water_natural_bodies, row.water_aquaculture_bodies) == (35, 2, 1)
    assert row.water_natural_ha == pytest.approx(26 * 0.09)


def test_road_metrics(spark):
    g = np.zeros((30, 30), dtype=bool)
    g[10:13, 0:30] = True
    g[20, 20:23] = True
    row = R.road_metrics(masks(spark, [g]), 30, 30, 900.0, 30.0).first()
    assert row.road_corridor_pixels == 90
    assert row.road_centerline_pixels == int(slow_thin(brute_open(g) | brute_open(g.T).T).sum())
    assert row.road_length_km == pytest.approx(row.road_centerline_pixels * 0.03)


def test_mosaic(spark):
    rows = [(0, 0, 0, 0, 1.0, None), (0, 0, 0, 1, None, None), (0, 1, 0, 0, 5.0, 6.0), (4, 0, 0, 0, 1.0, 2.0), (4, 0, 0, 0, 1.0, 3.0),
            (8, 0, 0, 0, 1.0, None), (8, 0, 0, 0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "row_off long, col_off long, row long, col long, a double, b double")
    got = {(r.row, r.col): (r.a, r.b, r.conflict) for r in R.mosaic(df, ["a", "b"]).collect()}
    assert got[(0, 0)] == (1.0, None, False) and got[(0, 1)] == (5.0, 6.0, False)
    assert got[(4, 0)][2] and got[(8, 0)][2]


def test_images_of_two_sizes(spark):
    small, large = np.zeros((8, 8), dtype=bool), np.zeros((20, 20), dtype=bool)
    small[0:4, 5:8] = True    # touches the right border of the small image only
    large[5:9, 5:8] = True
    mask = masks(spark, [small, large])
    images = spark.createDataFrame([("i0", 8, 8, 900.0, 30.0), ("i1", 20, 20, 100.0, 10.0)], "image_id string, height int, width int, pixel_area_m2 double, res_m double")
    opened = R.open_lines(mask, images=images)
    for k, g in enumerate((small, large)):
        assert np.array_equal(grids_of(opened.filter(f"image_id = 'i{k}'"), g.shape, 2)[k], brute_open(g) | brute_open(g.T).T)
    both = masks(spark, [np.ones((8, 8), dtype=bool), np.ones((20, 20), dtype=bool)])
    roads = {r.image_id: r for r in R.road_metrics(both, images=images).collect()}
    assert roads["i0"].road_area_ha == pytest.approx(64 * 0.09) and roads["i1"].road_area_ha == pytest.approx(400 * 0.01)
    assert roads["i1"].road_length_km == pytest.approx(roads["i1"].road_centerline_pixels * 0.01)
    assert {r.image_id: r.water_area_ha for r in R.water_metrics(both, images=images).collect()} == pytest.approx({"i0": 5.76, "i1": 4.0})
    assert {r.image_id: r.industrial_area_m2 for r in R.industrial_metrics(both, images=images).collect()} == pytest.approx({"i0": 57600.0, "i1": 40000.0})
    for wrong in (images.limit(1), images.union(images)):
        with pytest.raises(Exception, match="exactly one description"):
            R.open_lines(mask, images=wrong).collect()


def test_mosaics_keep_apart(spark):
    df = spark.createDataFrame([("m", 0, 0, 0, 0, 1.0), ("n", 0, 0, 0, 0, 2.0)], "mosaic string, row_off long, col_off long, row long, col long, a double")
    got = {r.mosaic: (r.a, r.conflict) for r in R.mosaic(df, ["a"], key=["mosaic"]).collect()}
    assert got == {"m": (1.0, False), "n": (2.0, False)}
