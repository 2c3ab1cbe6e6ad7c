"""riskflow: streaming fraud scoring as Spark DataFrame operators.

Main entry points (imported lazily)::

    from riskflow import (decode_transactions, to_event_time, flag_immediate,
                          velocity_features, flag_windowed, closed_velocity_features,
                          to_payload, parse_flags, explain_flags, start_pipeline,
                          start_explainer, FraudConfig)

Functions that run inside Python workers (Avro fallback codec, explainer
mapping) are pickled by value, so executors need no install of this package.
"""

import importlib as _importlib
import sys as _sys

_EXPORTS = {
    "FraudConfig": "riskflow.config",
    "decode_transactions": "riskflow.operators.ingest",
    "timed_transactions": "riskflow.operators.ingest",
    "to_wire": "riskflow.operators.ingest",
    "to_event_time": "riskflow.functions.eventtime",
    "score_immediate": "riskflow.operators.immediate",
    "flag_immediate": "riskflow.operators.immediate",
    "velocity_features": "riskflow.operators.velocity",
    "score_windowed": "riskflow.operators.velocity",
    "flag_windowed": "riskflow.operators.velocity",
    "closed_velocity_features": "riskflow.operators.velocity",
    "to_payload": "riskflow.operators.payload",
    "flagged_topic": "riskflow.operators.payload",
    "parse_flags": "riskflow.operators.payload",
    "explain_flags": "riskflow.operators.explain",
    "start_pipeline": "riskflow.streaming.pipeline",
    "start_explainer": "riskflow.streaming.explainer",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        return getattr(_importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'riskflow' has no attribute {name!r}")


def _ship_by_value() -> None:
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001 - an installed package works by reference
        pass


_ship_by_value()
