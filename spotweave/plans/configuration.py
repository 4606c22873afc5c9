"""The rounds configuration: parsing, validation and rule tables (C1 to C5, C8, C10, P16, IO14).

A configuration is a small JSON document, so it is parsed on the driver; every rule is checked and all faults are reported
together. What the operators join with comes out as rule tables, one row for each configured timepoint at most."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# The names that configurations use.
SEMANTICS = ("UniversalProximityPermission", "UniversalProximityProhibition", "SelectiveProximityPermission", "SelectiveProximityProhibition")
REQUIREMENTS = ("Conjunctive", "Disjunctive", "Lackadaisical")


class ConfigurationError(ValueError):
    """All faults of a configuration, in `faults`."""

    def __init__(self, faults: list[str]) -> None:
        super().__init__("; ".join(faults))
        self.faults = faults


@dataclass(frozen=True)
class Round:
    time: int
    name: str
    kind: str  # blank, locus or regional
    probe: str | None = None
    repeat: int | None = None


@dataclass(frozen=True)
class ProximityStrategy:
    semantic: str
    minimum_separation: float | None = None
    groups: tuple[tuple[int, ...], ...] = ()


@dataclass(frozen=True)
class MergeRules:
    groups: dict[str, tuple[int, ...]]
    distance_threshold: float
    requirement: str
    discard_others: bool


@dataclass(frozen=True)
class RoundsConfiguration:
    rounds: tuple[Round, ...]
    locus_grouping: dict[int, tuple[int, ...]]
    proximity: ProximityStrategy
    tracing_exclusions: frozenset[int] = frozenset()
    merge_rules: MergeRules | None = None
    checked_covering: bool = field(default=True)

    def times(self, kind: str) -> list[int]:
        return [r.time for r in self.rounds if r.kind == kind]

    def summary(self) -> dict[str, Any]:
        """Counts by kind and the groupings, for people."""
        return {"rounds": len(self.rounds), **{k: len(self.times(k)) for k in ("blank", "locus", "regional")}, "locusGrouping": {str(k): list(v) for k, v in self.locus_grouping.items()},
                "semantic": self.proximity.semantic, "tracingExclusions": sorted(self.tracing_exclusions), "mergeGroups": sorted(self.merge_rules.groups) if self.merge_rules else []}

    def rounds_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r.time, r.name, r.kind, r.probe, r.repeat) for r in self.rounds], "timepoint int, timepoint_name string, kind string, probe string, repeat int")

    def grouping_table(self, spark: SparkSession) -> DataFrame:
        """The locus timepoints of each regional one; with no grouping, all of them for every one."""
        of = self.locus_grouping or {t: tuple(self.times("locus")) for t in self.times("regional")}
        return spark.createDataFrame([(r, t) for r, ts in of.items() for t in ts], "ref_timepoint int, timepoint int")

    def proximity_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, i) for i, g in enumerate(self.proximity.groups) for t in g], "timepoint int, group_id int")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        of = self.merge_rules.groups if self.merge_rules else {}
        return spark.createDataFrame([(t, name) for name, g in of.items() for t in g], "timepoint int, traceGroup string")


def _is_time(x: Any) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x >= 0


def _repeated(xs: Iterable) -> list:
    return sorted(x for x, n in Counter(xs).items() if n > 1)


def length_nm(x: Any) -> float:
    """A positive length in nanometres from a number or from text such as "300 nm" or "0.3 um"."""
    scale = {"nm": 1.0, "um": 1000.0, "μm": 1000.0}
    parts = x.split() if isinstance(x, str) else [x, "nm"]
    if len(parts) != 2 or parts[1] not in scale or isinstance(parts[0], bool):
        raise ValueError(f"no length: {x!r}")
    value = float(parts[0]) * scale[parts[1]]
    if not 0 < value < float("inf"):
        raise ValueError(f"a length must be positive: {x!r}")
    return value


def parse_round(entry: Any) -> Round:
    """One entry of the sequence; the name comes from probe and repeat where it is not given."""
    if not isinstance(entry, dict) or not _is_time(entry.get("time")):
        raise ValueError(f"a round needs a nonnegative time: {entry!r}")
    time, name, probe, repeat = entry["time"], entry.get("name"), entry.get("probe"), entry.get("repeat")
    if repeat is not None and not (_is_time(repeat) and repeat > 0):
        raise ValueError(f"repeat of round {time} must be a positive integer")
    blank, regional = bool(entry.get("isBlank")), bool(entry.get("isRegional"))
    if blank:
        if name is None or regional or probe is not None:
            raise ValueError(f"blank round {time} needs a name and can neither be regional nor have a probe")
        return Round(time, name, "blank", None, repeat)
    if probe is None:
        raise ValueError(f"round {time} needs a probe")
    if regional and repeat is not None:
        raise ValueError(f"regional round {time} cannot be a repeat")
    return Round(time, name or probe + (f"_repeat{repeat}" if repeat else ""), "regional" if regional else "locus", probe, repeat)


def _sequence(entries: Any, faults: list[str]) -> tuple[Round, ...]:
    rounds = []
    for e in entries if isinstance(entries, list) else []:
        try:
            rounds.append(parse_round(e))
        except ValueError as x:
            faults.append(str(x))
    if not isinstance(entries, list):
        faults.append("imagingRounds must be a list")
    elif len(rounds) == len(entries):
        if sorted(r.time for r in rounds) != list(range(len(rounds))):
            faults.append("the times of the rounds must be 0, 1, 2 and so on")
        if bad := _repeated(r.name for r in rounds):
            faults.append(f"repeated names of rounds: {bad}")
        if not any(r.kind == "regional" for r in rounds):
            faults.append("there must be a regional round")
    return tuple(sorted(rounds, key=lambda r: r.time))


def _proximity(section: Any, regionals: set[int], faults: list[str]) -> ProximityStrategy | None:
    if not isinstance(section, dict) or section.get("semantic") not in SEMANTICS:
        faults.append(f"proximityFilterStrategy needs a semantic of {', '.join(SEMANTICS)}")
        return None
    semantic = section["semantic"]
    needs = {"minimumSeparation": semantic != SEMANTICS[0], "groups": semantic in SEMANTICS[2:]}
    for key, needed in needs.items():
        if needed != (section.get(key) is not None):
            faults.append(f"{key} is {'required' if needed else 'not allowed'} with {semantic}")
            return None
    separation, groups = None, ()
    if needs["minimumSeparation"]:
        try:
            separation = length_nm(section["minimumSeparation"])
        except ValueError as x:
            faults.append(str(x))
    if needs["groups"]:
        listed = section["groups"]
        if not isinstance(listed, list) or not listed or not all(isinstance(g, list) and g and all(map(_is_time, g)) for g in listed):
            faults.append("groups of the proximity filter must be lists of timepoints")
            return None
        groups = tuple(map(tuple, listed))
        members = [t for g in groups for t in g]
        if bad := _repeated(members):
            faults.append(f"timepoints in the groups of the proximity filter more than once: {bad}")
        if extra := sorted(set(members) - regionals):
            faults.append(f"timepoints in the groups of the proximity filter that are not regional: {extra}")
        if missing := sorted(regionals - set(members)):
            faults.append(f"regional timepoints in no group of the proximity filter: {missing}")
    return ProximityStrategy(semantic, separation, groups)


def _merge_rules(section: Any, regionals: set[int], faults: list[str]) -> MergeRules | None:
    if section is None:
        return None
    before = len(faults)
    if not isinstance(section, dict):
        faults.append("mergeRulesForTracing must be a mapping")
        return None
    groups, threshold = section.get("groups"), None
    if not isinstance(groups, dict) or not groups or not all(isinstance(g, list) and all(map(_is_time, g)) for g in groups.values()):
        faults.append("groups of the merge rules must map names to lists of timepoints")
    else:
        members = [t for g in groups.values() for t in g]
        if small := sorted(k for k, g in groups.items() if len(set(g)) < 2):
            faults.append(f"merge groups of fewer than two members: {small}")
        if bad := _repeated(members):
            faults.append(f"timepoints in merge groups more than once: {bad}")
        if extra := sorted(set(members) - regionals):
            faults.append(f"timepoints in merge groups that are not regional: {extra}")
    try:
        threshold = length_nm(section.get("distanceThreshold"))
    except (TypeError, ValueError) as x:
        faults.append(f"distanceThreshold of the merge rules: {x}")
    if section.get("requirementType") not in REQUIREMENTS:
        faults.append(f"requirementType must be one of {', '.join(REQUIREMENTS)}")
    if not isinstance(section.get("discardRoisNotInGroupsOfInterest"), bool):
        faults.append("discardRoisNotInGroupsOfInterest must be true or false")
    if len(faults) > before:
        return None
    return MergeRules({k: tuple(g) for k, g in groups.items()}, threshold, section["requirementType"], section["discardRoisNotInGroupsOfInterest"])


def _grouping(section: Any, loci: set[int], regionals: set[int], exclusions: set[int], covering: bool, faults: list[str]) -> dict[int, tuple[int, ...]]:
    if not section:
        return {}
    if not isinstance(section, dict) or not all(k.isdecimal() and isinstance(v, list) and all(map(_is_time, v)) for k, v in section.items()):
        faults.append("locusGrouping must map regional timepoints to lists of locus timepoints")
        return {}
    found = {int(k): tuple(v) for k, v in section.items()}
    if bad := sorted(k for k, v in found.items() if _repeated(v)):
        faults.append(f"lists of the locus grouping with repeats: {bad}")
    if bad := sorted(set(found) - regionals):
        faults.append(f"keys of the locus grouping that are not regional: {bad}")
    if missing := sorted(regionals - set(found) - exclusions):
        faults.append(f"regional timepoints that are neither in the locus grouping nor excluded from tracing: {missing}")
    named = {t for v in found.values() for t in v}
    if extra := sorted(named - loci):
        faults.append(f"timepoints in the locus grouping that are not locus timepoints: {extra}")
    if covering and (missing := sorted(loci - named - exclusions)):
        faults.append(f"locus timepoints that are neither in the locus grouping nor excluded from tracing: {missing}")
    return found


def parse_configuration(data: str | dict) -> RoundsConfiguration:
    """The configuration in a JSON text or mapping; raises ConfigurationError with every fault found."""
    found = json.loads(data) if isinstance(data, str) else data
    if not isinstance(found, dict):
        raise ConfigurationError(["the configuration must be a mapping"])
    faults: list[str] = []
    rounds = _sequence(found.get("imagingRounds"), faults)
    of = lambda kind: {r.time for r in rounds if r.kind == kind}
    listed = found.get("tracingExclusions") or []
    if not isinstance(listed, list) or not all(map(_is_time, listed)):
        faults.append("tracingExclusions must be a list of timepoints")
        listed = []
    if unknown := sorted(set(listed) - {r.time for r in rounds}):
        faults.append(f"tracingExclusions that are no timepoints of the sequence: {unknown}")
    covering = found.get("checkLocusTimepointCovering", True)
    if not isinstance(covering, bool):
        faults.append("checkLocusTimepointCovering must be true or false")
    grouping = _grouping(found.get("locusGrouping"), of("locus"), of("regional"), set(listed), covering is not False, faults)
    proximity = _proximity(found.get("proximityFilterStrategy"), of("regional"), faults)
    rules = _merge_rules(found.get("mergeRulesForTracing"), of("regional"), faults)
    if rules and grouping:
        for name, times in rules.groups.items():
            if bad := _repeated(x for t in times for x in grouping.get(t, ())):
                faults.append(f"regional timepoints of merge group {name} share locus timepoints: {bad}")
    if faults or proximity is None:
        raise ConfigurationError(faults)
    return RoundsConfiguration(rounds, grouping, proximity, frozenset(listed), rules, covering)


def read_configuration(spark: SparkSession, path: str) -> RoundsConfiguration:
    """From a file in any store that Spark reads."""
    return parse_configuration(spark.read.text(path, wholetext=True).first()[0])


def bead_timepoint(parameters: dict[str, Any], rounds: Iterable[Round], background_key: str = "subtract_background") -> int:
    """The blank timepoint whose beads filter spots (C8): a timepoint itself, or true for that of the background."""
    key = "proximityFiltrationBetweenBeadsAndSpots"
    value = parameters.get(key)
    time = parameters.get(background_key) if value is True else value
    if not _is_time(time):
        raise ConfigurationError([f"{key} gives no timepoint: {value!r}"])
    kinds = {r.time: r.kind for r in rounds}
    if kinds.get(time) != "blank":
        raise ConfigurationError([f"timepoint {time} of the beads is {kinds.get(time, 'no round')}, not blank"])
    return time
