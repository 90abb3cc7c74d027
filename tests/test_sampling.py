from dataclasses import replace

import numpy as np
import pytest

from laserfold.operators import sampling, tiling
from laserfold.params import SITE, GridParams

P = GridParams(sample_points=20)


def cloud(n, seed=3):
    rng = np.random.default_rng(seed)
    return [(*map(float, xyz), 2) for xyz in rng.uniform(0, 24, (n, 3))]


def brute_sample(points, k):
    chosen = [0]
    while len(chosen) < k:
        gaps = [min(np.sum((points[i] - points[j]) ** 2) for j in chosen) for i in range(len(points))]
        chosen.append(int(np.argmax(gaps)))
    return [tuple(points[i]) for i in chosen]


def test_sample_matches_brute_force(make_points):
    voxels = sampling.voxel_downsample(tiling.assign_tiles(make_points(cloud(120)), P), P)
    ordered = voxels.orderBy("vx", "vy", "vz").select("x", "y", "z").collect()
    want = brute_sample(np.array([tuple(r) for r in ordered]), 20)
    got = sampling.farthest_points(voxels.repartition(5), P).orderBy("seq").collect()
    assert [(r["x"], r["y"], r["z"]) for r in got] == want


def test_small_tiles_pass_whole(make_points):
    voxels = sampling.voxel_downsample(tiling.assign_tiles(make_points(cloud(7)), P), P)
    assert sampling.farthest_points(voxels, P).count() == 7


def test_tensor_is_centred_and_scaled(make_points):
    row = sampling.tensors(tiling.assign_tiles(make_points(cloud(90)), P), P).first()
    tensor = np.array(row["tensor"])
    assert tensor.shape == (20, 3)
    assert np.abs(tensor.mean(axis=0)).max() < 1e-6
    assert np.linalg.norm(tensor, axis=1).max() == pytest.approx(1.0, abs=1e-6)


def test_one_voxel_gives_a_zero_vector(make_points):
    tiled = tiling.assign_tiles(make_points([(1, 1, 1, 2), (1.01, 1.01, 1.01, 2)]), P)
    row = sampling.tensors(tiled, replace(P, voxel_m=5.0)).first()
    assert row["tensor"] == [[0.0, 0.0, 0.0]]


def test_voxels_of_two_sites_stay_apart(make_points):
    both = make_points([(1, 1, 1, 2)]).unionByName(make_points([(1, 1, 1, 2)], site="t"))
    assert sampling.voxel_downsample(tiling.assign_tiles(both, P, SITE), P).count() == 2


@pytest.mark.parametrize(("n", "grid"), [(3000, None), (3000, 9), (130, 3), (64, None), (65, 1)])
def test_boxes_pick_as_a_scan_does(n, grid):
    """2048 picks and more points, on a lattice too, where most gaps are equal."""
    rng = np.random.default_rng(n)
    at = rng.uniform(0, 25, (n, 3)) if grid is None else rng.integers(0, grid, (n, 3)).astype(float)
    wanted = min(2048, n - 1)
    gaps, want = np.full(n, np.inf), [0]
    while len(want) < wanted:
        d = at - at[want[-1]]
        gaps = np.minimum(gaps, d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2])
        want.append(int(gaps.argmax()))
    assert sampling.farthest(at, wanted).tolist() == want


def test_tensor_is_the_normalized_sample(make_points):
    voxels = sampling.voxel_downsample(tiling.assign_tiles(make_points(cloud(150)), P), P)
    sample = sampling.farthest_points(voxels, P)
    unit = sampling.normalize(sample, ["siteId", "tileId"]).orderBy("seq").collect()
    tensor = sampling.voxel_tensors(voxels.repartition(3), P).first()["tensor"]
    assert np.allclose(tensor, [(r.x, r.y, r.z) for r in unit], atol=1e-6)
