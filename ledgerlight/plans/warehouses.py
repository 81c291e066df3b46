"""Warehouse change history (K14) and the size -> credits map (A4)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.history import scd2
from ledgerlight.sources.seeds import warehouse_credits_map  # noqa: F401  (re-export)
from ledgerlight.sources.staging import Staged


def warehouses_type2_dimension(st: Staged) -> DataFrame:
    """Validity periods of each warehouse's (size, name) as seen in the query log.

    The open period ends at the latest query start in the log (not null); ties on the
    start time are ordered by query id."""
    qh = st.query_history()
    stop = qh.agg(F.max("start_time")).scalar()
    obs = qh.where(F.col("warehouse_size").isNotNull()).select(
        "warehouse_id", "warehouse_size", "warehouse_name", "start_time", "query_id")
    out = scd2(obs, "warehouse_id", ["warehouse_size", "warehouse_name"], "start_time", stop,
               tiebreak=["query_id"])
    return out.select("warehouse_id", "warehouse_name", "warehouse_size", "valid_from", "valid_to", "is_current")
