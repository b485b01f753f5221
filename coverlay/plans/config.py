from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleanConfig:
    """Settings of a cleaning run. Lengths are in coordinate units (degrees by default).

    The defaults are fixed values: results for national data depend on them to the last digit.
    """

    #: grid cell for joins of localities, pieces and zones
    cell: float = 0.25
    #: rows per grid cell above which a join cuts the cell into smaller ones (None: leave hot cells to the engine)
    hot_cell: int | None = None
    #: border corridors: line thinning, half width, buffer corner steps
    border_simplify: float = 0.001
    border_width: float = 0.015
    border_quadrants: int = 1
    #: vertex limit of a subdivided corridor or state tile, and segments per run of a chopped line
    max_points: int = 512
    max_segments: int = 64
    #: paired-buffer amounts: gap slivers, gap growth before a cut, final clean-up
    gap_open: tuple[float, float] = (-2e-8, 2e-8)
    gap_grow: tuple[float, float] = (-1e-8, 2e-8)
    final_open: tuple[float, float] = (-1e-8, 1e-8)
    #: gaps smaller than this many square metres are not worth splitting; None keeps all
    min_gap_area: float | None = 1.0
    #: how gap and locality meet: 'boundary' = outlines within ``contact_tolerance``; 'overlap' = shared area
    contact: str = "boundary"
    contact_tolerance: float = 1e-7
    #: how far a splitter line runs past both of its ends
    overshoot: float = 1e-5
    #: zones that hold no gap of their own but touch one: add them as gaps (True) or only if no locality meets them
    add_covered_zones: bool = True
    #: localities never taken for border slivers; localities kept whatever their match; a point that unsets a piece
    sliver_exceptions: tuple[str, ...] = ("NSW2046",)
    always_keep: tuple[str, ...] = ("loc53bd3a3a3b1f",)
    drop_at: tuple[float, float] | None = (144.227305683, -9.39107887741)
    #: display thinning: area tolerance, snapping grid
    thin_tolerance: float = 9.208633852887194e-09
    snap_size: float = 0.00001
    #: growth that closes hairlines between localities of one postcode
    postcode_grow: float = 0.000001
    #: postcodes that stand for "none"
    no_postcode: tuple[str, ...] = ("NA", "9999")
