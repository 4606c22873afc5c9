"""The parameters of a run: YAML of the plain kind, its checks, trace metadata and signal specifications (C6, C7, C9, IO14).

All faults are found at once and raised together."""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass
from typing import Any

from spotweave.plans.configuration import ConfigurationError, bead_timepoint, length_nm, parse_configuration

# Keys of the parameters, and what has become of old ones.
REQUIRED = ("zarr_conversions", "decon_input_name", "decon_output_name")
GONE = {
    "reg_ref_frame": "is now reg_ref_timepoint", "spot_frame": "belongs to the rounds configuration", "subtract_crosstalk": "is no longer supported",
    "crosstalk_ch": "is no longer supported", "min_spot_dist": "belongs to the rounds configuration",
}
DRIFT_METHODS = ("cc", "fit")
LENGTHS = ("distanceBeneathWhichSpotRoisWillMerge", "max_dist")
ROI_TYPES = ("LocusSpecific", "Regional")


def read_yaml(text: str) -> Any:
    """Mappings and lists by indentation, flow lists, scalars and comments: what parameter files hold. Anchors, tags and
    block scalars are errors."""
    lines = []
    for number, raw in enumerate(text.split("\n"), 1):
        body = re.sub(r"(^|\s)#.*$", "", raw).rstrip()
        if body.strip() and body.strip() != "---":
            if re.match(r"\s*\t", body) or re.search(r":\s+[|>&*!]", body):
                raise ValueError(f"line {number} is beyond this reader: {raw!r}")
            lines.append((len(body) - len(body.lstrip()), body.strip()))
    value, rest = _block(lines, 0)
    if rest < len(lines):
        raise ValueError(f"unexpected indentation before {lines[rest][1]!r}")
    return value


def _scalar(text: str) -> Any:
    if text.startswith("[") and text.endswith("]"):
        inner = text[1:-1].strip()
        return [_scalar(x.strip()) for x in inner.split(",")] if inner else []
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1]
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    if text in ("", "~", "null", "Null", "NULL"):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _block(lines: list[tuple[int, str]], at: int) -> tuple[Any, int]:
    if at >= len(lines):
        return None, at
    depth = lines[at][0]
    out: Any = [] if lines[at][1].startswith("- ") or lines[at][1] == "-" else {}
    while at < len(lines) and lines[at][0] == depth:
        body = lines[at][1]
        if isinstance(out, list):
            if not body.startswith("-"):
                break
            out.append(_scalar(body[1:].strip()))
            at += 1
            continue
        key, found, value = body.partition(":")
        if not found:
            raise ValueError(f"no mapping entry: {body!r}")
        name = _scalar(key.strip())
        if name in out:
            raise ValueError(f"the key {name} stands twice")
        at += 1
        if value.strip():
            out[name] = _scalar(value.strip())
        elif at < len(lines) and (lines[at][0] > depth or (lines[at][0] == depth and lines[at][1].startswith("- "))):
            out[name], at = _block(lines, at)
        else:
            out[name] = None
    return out, at


def merged(rounds: str, parameters: str) -> dict[str, Any]:
    """The rounds' JSON and the parameters' YAML in one mapping; a key of both is an error (IO14)."""
    a, b = json.loads(rounds), read_yaml(parameters) or {}
    if both := sorted(set(a) & set(b)):
        raise ConfigurationError([f"keys in both files: {both}"])
    return {**b, **a}


def parameter_faults(parameters: dict[str, Any], rounds: dict[str, Any]) -> list[str]:
    """Everything that is wrong with the parameters of a run."""
    faults = [f"no value for {k}" for k in REQUIRED if not parameters.get(k)]
    faults += [f"{k} {why}" for k, why in GONE.items() if k in parameters]
    if not parameters.get("require_gpu"):
        faults.append("deconvolution requires a GPU: require_gpu must be true")
    if parameters.get("nuc_3d"):
        faults.append("nuclei are not detected in three dimensions: nuc_3d must be false")
    if parameters.get("nuc_method") != "cellpose":
        faults.append(f"nuc_method must be cellpose, not {parameters.get('nuc_method')!r}")
    if parameters.get("nuc_ref_timepoint", 0) != 0:
        faults.append("nuc_ref_timepoint must be 0 if it is given")
    if (method := parameters.get("dc_method")) and method not in DRIFT_METHODS:
        faults.append(f"dc_method must be one of {', '.join(DRIFT_METHODS)}, not {method!r}")
    if (method := parameters.get("detection_method")) is None:
        faults.append("no detection_method")
    elif method == "intensity":
        faults.append("detection_method intensity is not supported")
    for key in LENGTHS:
        try:
            if not isinstance(parameters.get(key), str):
                raise ValueError(f"text with a unit is needed, not {parameters.get(key)!r}")
            length_nm(parameters[key])
        except ValueError as x:
            faults.append(f"{key}: {x}")
    if parameters.get("mask_fits"):
        faults.append("mask_fits is not supported")
    if not rounds.get("tracingExclusions"):
        faults.append("tracingExclusions must list a timepoint")
    try:
        known = parse_configuration(rounds)
    except ConfigurationError as x:
        return faults + x.faults
    try:
        bead_timepoint(parameters, known.rounds)
    except ConfigurationError as x:
        faults += x.faults
    return faults


def precheck(parameters: dict[str, Any], rounds: dict[str, Any]) -> None:
    if faults := parameter_faults(parameters, rounds):
        raise ConfigurationError(faults)


def trace_groups(section: Any) -> dict[str, frozenset[int]]:
    """Named groups of two regional times or more, no name and no time in two of them."""
    if not isinstance(section, dict) or not section:
        raise ConfigurationError(["trace groups must map names to lists of times"])
    faults = []
    for name, times in section.items():
        if not isinstance(name, str) or not name.strip():
            faults.append(f"no name of a trace group: {name!r}")
        if not isinstance(times, list) or not all(isinstance(t, int) and not isinstance(t, bool) and t >= 0 for t in times):
            faults.append(f"the times of {name} must be a list of timepoints")
        elif len(times) < 2 or len(set(times)) < len(times):
            faults.append(f"the times of {name} must be two or more, none of them twice")
    if not faults and (bad := sorted(t for t, n in Counter(t for g in section.values() for t in g).items() if n > 1)):
        faults.append(f"times in several trace groups: {bad}")
    if faults:
        raise ConfigurationError(faults)
    return {k: frozenset(v) for k, v in section.items()}


@dataclass(frozen=True)
class SignalSpecification:
    """What to measure around spots: their type, the diameter in pixels and the channels."""

    roi_type: str
    roi_diameter: int
    channels: frozenset[int]


def signal_specification(data: dict[str, Any]) -> SignalSpecification:
    faults = [f"no {k}" for k in ("roiType", "roiDiameterInPixels", "channels") if k not in data]
    kind, size, channels = data.get("roiType"), data.get("roiDiameterInPixels"), data.get("channels")
    if kind is not None and kind not in ROI_TYPES:
        faults.append(f"roiType must be one of {', '.join(ROI_TYPES)}")
    if size is not None and (not isinstance(size, int) or isinstance(size, bool) or size <= 0):
        faults.append(f"roiDiameterInPixels must be a positive integer, not {size!r}")
    if channels is not None and (not isinstance(channels, list) or not all(isinstance(c, int) and c >= 0 for c in channels) or len(set(channels)) < len(channels)):
        faults.append("channels must be a list of different nonnegative integers")
    if faults:
        raise ConfigurationError(faults)
    return SignalSpecification(kind, size, frozenset(channels))
