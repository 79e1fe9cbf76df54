"""Reading and generating layer tables."""

from layerspark.sources.generate import (
    clustered_points,
    gen_clustered,
    gen_points,
    gen_square_grid,
    scatter_points,
    square_grid,
)
from layerspark.sources.scan import scan_cell_stats, scan_layer

__all__ = [
    "clustered_points",
    "gen_clustered",
    "gen_points",
    "gen_square_grid",
    "scan_cell_stats",
    "scan_layer",
    "scatter_points",
    "square_grid",
]
