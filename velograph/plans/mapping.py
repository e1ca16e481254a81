"""E4 — sensor → road-edge mapping pipeline with persisted intermediates.

candidates (cell join) → direction filter → nearest edge → coverage → kNN/IDW
for uncovered edges → QA rules → coverage statistics. The two expensive
tables (distance candidates and IDW weights) are written once to the shared
checkpoint folder (the reference persists its mapping tables too); every
derived report reads them instead of re-running the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from velograph.operators import spatial
from velograph.session import materialize


def mapping_pipeline(sensors: DataFrame, edges: DataFrame, persist: bool = True, run_at: str | None = None) -> dict[str, DataFrame]:
    cand = spatial.candidates(sensors, edges)
    if persist:
        cand = materialize(cand, "map-candidates")
    parts = spatial.map_sensors(sensors, edges, cand=cand)
    targets = spatial.edge_geometry(edges).join(parts["covered"], "edge_id", "left_anti")
    weights = spatial.knn_idw(sensors, targets.select("edge_id", "cx", "cy"))
    if persist:
        weights = materialize(weights, "idw-weights")
    interp = spatial.interpolation_summary(weights)
    errors = spatial.qa_errors(sensors, parts, interp)
    out = dict(parts)
    out.update(weights=weights, interp=interp, errors=errors,
               stats=spatial.mapping_stats(sensors, edges, parts, interp, errors, run_at))
    return out
