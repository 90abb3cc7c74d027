"""Tunable values and the fixed codes of the point format."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data format: LAS class codes, state names and labels that appear
# in tables, and the documented limits.
WATER_CLASS = 9
GROUND_CLASSES = (2,)
JOB_STATES = ("CREATED", "QUEUED", "DBX_TRIGGERED", "PROCESSING", "SUCCEEDED", "FAILED")
RUN_FAILED_CODE = "DBX_RUN_FAILED"
GRID_ALGORITHM = "mvp_grid_v1"
FROM_DEFAULTS, FROM_CONTROL = "code-defaults", "control-table"
CANDIDATE_TARGETS = (50_000, 100_000, 150_000, 250_000, 400_000, 600_000)
ACCEPTABLE_SECONDS = 120.0
ERROR_CODE_CHARS = 64
ERROR_MESSAGE_CHARS = 2048

# One snapshot of one site. Every operator groups by a scope, so all sites (and,
# with the second form, all ingest runs) go through in one pass.
SITE = ("siteId",)
SITE_RUN = ("siteId", "ingestRunId")


@dataclass(frozen=True)
class GridParams:
    """Sizes and thresholds; the defaults are the documented production values."""

    tile_size_m: float = 25.0
    cell_size_m: float = 0.5
    patch_cells: int = 8

    water_class: int = WATER_CLASS
    mostly_water_ratio: float = 0.60
    skip_water_ratio: float = 0.8
    patch_water_ratio: float = 0.7
    water_cell_ratio: float = 0.7
    min_tile_points: int = 5_000

    hot_tile_threshold: int = 100_000
    target_points_per_bucket: int = 600_000
    salt_buckets: int = 16
    enable_salt: bool = False

    min_points_used: int = 200
    min_height_above_ground: float = 2.5
    max_height_range: float = 3.0
    min_patch_area_m2: float | None = None

    voxel_m: float = 0.2
    sample_points: int = 2048

    @property
    def cells_per_tile(self) -> int:
        cells = int(round(self.tile_size_m / self.cell_size_m))
        if cells < 1:
            raise ValueError("tile_size_m must hold at least one cell")
        return cells
