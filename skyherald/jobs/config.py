"""Job settings from a JSON file: class rules, grade rules and thresholds are a survey's own."""

from __future__ import annotations

import json

from skyherald.operators.grade import GradeRules
from skyherald.plans.crossmatch import MatchSettings


def load(path: str) -> tuple[MatchSettings, GradeRules]:
    """{"match": {MatchSettings fields}, "grades": {GradeRules fields}}."""
    with open(path) as f:
        raw = json.load(f)
    match, grades = dict(raw["match"]), dict(raw["grades"])
    match["class_rules"] = [tuple(r) for r in match["class_rules"]]
    if "tiers" in match:
        match["tiers"] = tuple(tuple(t) for t in match["tiers"])
    grades["extragalactic"] = tuple(grades["extragalactic"])
    return MatchSettings(**match), GradeRules(**grades)
