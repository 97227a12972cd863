"""Search knobs: a call's own value, else the one saved for the index, else the default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmerdex import decisions as D

FIELD_KNOBS = {"fw_title": "title", "fw_description": "description", "fw_uri": "uri", "fw_text": "text", "fw_text_t": "text_t"}

DEFAULTS = {
    "fw_title": D.HYBRID_WEIGHTS["title"],
    "fw_description": 0.0,
    "fw_uri": 0.0,
    "fw_text": D.HYBRID_WEIGHTS["text"],
    "fw_text_t": 0.0,
    "lexical_weight": 0.5,
    "vector_weight": 0.5,
    "vector_topk": None,
    "search_mode": "union",
    "quality_boost": 0.0,
    "freshness_boost": 0.0,
    "min_score": None,
    "lexical_norm_k": None,
    "mm": "flexible",
}


def resolve(calls: DataFrame, saved: DataFrame, defaults: dict, index_col: str = "index") -> DataFrame:
    """Each call row with every knob settled; `saved` has one row per index."""
    knobs = list(defaults)
    kept = saved.select(index_col, *[F.col(k).alias(f"_{k}") for k in knobs if k in saved.columns])
    rows = calls.join(kept, index_col, "left")

    def settled(knob: str):
        options = [F.col(c) for c in (knob, f"_{knob}") if c in rows.columns]
        return F.coalesce(*options, F.lit(defaults[knob])).alias(knob)

    identity = [c for c in calls.columns if c not in knobs]
    return rows.select(*identity, *[settled(k) for k in knobs])


def knobs(call: dict | None = None, saved: dict | None = None) -> dict:
    """The same for one call, with the field weights gathered."""
    call, saved = call or {}, saved or {}
    unknown = (set(call) | set(saved)) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown knobs: {sorted(unknown)}")
    values = {
        k: next((v for v in (call.get(k), saved.get(k)) if v is not None), default) for k, default in DEFAULTS.items()
    }
    values["weights"] = {field: values[knob] for knob, field in FIELD_KNOBS.items() if values[knob]}
    return values
