"""Compare a Spark result with the DuckDB oracle: rows, column names, and values
(order-insensitive, doubles within a tolerance)."""
from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(x.item() if hasattr(x, "item") and not isinstance(x, (str, bytes)) else x)
                          for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, duck_pdf: pd.DataFrame, tol: float = 1e-6) -> dict:
    spdf = spark_df.toPandas()
    out = {"spark_rows": len(spdf), "oracle_rows": len(duck_pdf),
           "columns_match": sorted(spdf.columns) == sorted(duck_pdf.columns)}
    if not out["columns_match"]:
        out["spark_cols"] = sorted(spdf.columns)
        out["oracle_cols"] = sorted(duck_pdf.columns)
        out["ok"] = False
        return out
    a, b = frame_rows(spdf), frame_rows(duck_pdf)
    mismatches = []
    if len(a) == len(b):
        for ra, rb in zip(a, b):
            for x, y in zip(ra, rb):
                if x == y:
                    continue
                if isinstance(x, (int, float)) and isinstance(y, (int, float)) and \
                        abs(x - y) <= tol * max(1.0, abs(x), abs(y)):
                    continue
                mismatches.append((ra, rb))
                break
            if len(mismatches) >= 3:
                break
    out["values_match"] = len(a) == len(b) and not mismatches
    out["examples"] = mismatches[:3]
    out["ok"] = out["values_match"] and out["columns_match"]
    return out
