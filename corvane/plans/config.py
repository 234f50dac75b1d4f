"""The configuration of a run: YAML, checked, as plain values on the driver."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from types import SimpleNamespace
from typing import NamedTuple

#: What a configuration may and must say.
SCOPES = ("comuna", "barrio", "bbox", "all")
DEFINITIONS = ("all_intersections", "formal_crossings_only", "hybrid")
METHODS = ("minmax", "percentile")
AXIS_METHODS = ("minmax", "percentile", "binary", "zero_inflated")
AXES = ("crossing_length", "n_branches", "acute_angle", "roadway_width", "no_refuge", "speed_limit", "has_ped_signal", "traffic_calming", "crossing_marked", "near_school", "crash_history", "ped_flow_proxy", "heavy_traffic")
RADII = ("school_radius_m", "crash_radius_m", "ped_flow_radius_m", "ped_signal_radius_m", "traffic_calming_radius_m")
REQUIRED = ("scope", "corner_definition", "node_merge_threshold_m", "angle_normal_range", "radii", "normalization", "weights")
SEVERITY = {"LEVE": 1.0, "GRAVE": 3.0, "MORTAL": 5.0}
FLOW = {"paradas": 1.0, "subte": 3.0, "ferrocarril": 2.0}
NETWORK = {"bearing_sample_m": 15.0, "branch_dedupe_bucket_deg": 30.0, "min_branches": 3}
CROSSING = {"offset_m": 12.0, "max_width_m": 40.0, "sidewalk_search_radius_m": 80.0}


class Config(SimpleNamespace):
    """A checked configuration; an attribute for each row of ``SETTINGS``, and ``warnings``."""

    def flat_weights(self) -> dict[str, float]:
        """Axis to weight, in the file's order."""
        return {axis: float(w) for group in self.weights.values() for axis, w in group.items()}


class Setting(NamedTuple):
    #: where the file says it, keys of nested groups with dots between
    key: str
    attribute: str
    #: what makes a value of what the file says, or raises
    read: Callable
    #: what stands where the file says nothing
    usual: object = None


def _one_of(*allowed: str) -> Callable:
    def read(value):
        if value not in allowed:
            raise ValueError(f"{value!r} is none of {', '.join(allowed)}")
        return value

    return read


def _range(value) -> tuple[float, float]:
    if not isinstance(value, list) or len(value) != 2:
        raise ValueError("a list of two degrees is needed")
    return float(value[0]), float(value[1])


def _scope(value: dict) -> dict:
    scope = {"mode": None, "comuna": None, "barrio": None, "bbox": None, "buffer_m": 40.0} | value
    _one_of(*SCOPES)(scope["mode"])
    return scope | {"buffer_m": float(scope["buffer_m"])}


def _radii(value: dict) -> dict[str, float]:
    if missing := sorted(set(RADII) - set(value)):
        raise ValueError(f"missing radii: {missing}")
    return {k: float(v) for k, v in value.items()}


def _overrides(value: dict) -> dict[str, str]:
    return {axis: _one_of(*AXIS_METHODS)(method) for axis, method in value.items()}


def _numbers(upper: bool = False) -> Callable:
    return lambda value: {k.upper() if upper else k: float(v) for k, v in value.items()}


def _like(usual: dict) -> Callable:
    """Of the usual values' names and types."""
    return lambda value: {k: type(v)(value.get(k, v)) for k, v in usual.items()}


SETTINGS = (
    Setting("normalization", "method", _one_of(*METHODS)),
    Setting("axis_normalization", "overrides", _overrides, {}),
    Setting("weights", "weights", dict),
    Setting("crash_severity_weights", "severity_weights", _numbers(upper=True), SEVERITY),
    Setting("ped_flow_weights", "flow_weights", _numbers(), FLOW),
    Setting("scope", "scope", _scope),
    Setting("radii", "radii", _radii),
    Setting("corner_definition", "corner_definition", _one_of(*DEFINITIONS)),
    Setting("node_merge_threshold_m", "merge_m", float),
    Setting("angle_normal_range", "normal", _range),
    Setting("network", "network", _like(NETWORK), NETWORK),
    Setting("crossing_measurement", "crossing", _like(CROSSING), CROSSING),
    Setting("crash_trend.early", "crash_early", tuple, (2019, 2021)),
    Setting("crash_trend.late", "crash_late", tuple, (2023, 2025)),
    Setting("report.intervention_threshold", "threshold", float, 0.75),
    Setting("report.top_n", "report_top_n", int, 100),
    Setting("report.fichas_top_n", "fichas_top_n", lambda n: None if n in (None, "all") else int(n)),
)


def _said(raw: dict, key: str):
    """What the file says, None if nothing."""
    for part in key.split("."):
        raw = (raw or {}).get(part)
    return raw


def parse(raw: dict) -> Config:
    if missing := [k for k in REQUIRED if k not in raw]:
        raise ValueError(f"missing keys: {missing}")
    config = Config()
    for s in SETTINGS:
        said = _said(raw, s.key)
        try:
            # An empty group counts as none.
            setattr(config, s.attribute, s.read(s.usual if said in (None, {}) and s.usual is not None else said))
        except (ValueError, TypeError, AttributeError) as e:
            raise ValueError(f"{s.key}: {e}") from e
    named = {*config.flat_weights(), *config.overrides}
    config.warnings = [f"unknown axis: {a}" for a in sorted(named - set(AXES))]
    return config


def load(path: str | Path) -> Config:
    import yaml

    if not Path(path).exists():
        raise FileNotFoundError(str(path))
    config = parse(yaml.safe_load(Path(path).read_text(encoding="utf-8")))
    for line in config.warnings:
        print(line)
    return config
