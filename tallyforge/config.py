"""Configuration folder of YAML files to small tables.

Unknown keys are errors that name the file and the field. The tables grow with
the configuration only.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import timedelta
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession


PERIODS = ("Q1", "Q2", "Q3", "Q4", "H1", "H2", "9M", "FY")
REPORT_STANDARDS = ("IFRS", "RSBU", "ISSUER")
PLACEHOLDER = "REPLACE_ME"
SECRET = re.compile(r"key|token|secret|password|credential", re.I)


class ConfigError(ValueError):
    """A file or field that cannot be used."""


def _known(data: Any, allowed: set[str], where: str) -> dict:
    if not isinstance(data, dict):
        raise ConfigError(f"{where}: expected a mapping")
    if extra := sorted(set(data) - allowed):
        raise ConfigError(f"{where}: unknown field {extra[0]!r}")
    return data


@dataclass(frozen=True)
class MetricSpec:
    profile: str
    metric_name: str
    unit: str
    synonyms: list[str] = field(default_factory=list)
    scale_hints: list[str] = field(default_factory=list)
    only_in_sources: list[str] | None = None
    aggregation_hint: str | None = None


@dataclass(frozen=True)
class Ticker:
    ticker: str
    name: str
    e_disclosure_id: str
    profile: str = "non_bank"
    inn: str | None = None
    ogrn: str | None = None
    use_vision_extraction: bool = False


@dataclass(frozen=True)
class EventType:
    code: str
    display_name: str
    aliases: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Settings:
    metrics: list[MetricSpec]
    priorities: dict[str, list[str]]
    tickers: list[Ticker]
    event_types: list[EventType]
    other: dict[str, dict]


def _read(folder: Path, name: str) -> Any:
    path = folder / name
    try:
        return yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    except FileNotFoundError as e:
        raise ConfigError(f"{name}: missing") from e
    except yaml.YAMLError as e:
        raise ConfigError(f"{name}: {e}") from e


def load(folder: str) -> Settings:
    """Always read anew; app, llm and ocr settings are kept as mappings."""
    base = Path(folder)
    profiles = _known(_read(base, "metrics.yaml"), {"profiles"}, "metrics.yaml").get("profiles", {})
    metrics, priorities = [], {}
    for profile, body in profiles.items():
        where = f"metrics.yaml: profiles.{profile}"
        _known(body, {"metrics", "reporting_priority"}, where)
        priorities[profile] = body.get("reporting_priority", list(REPORT_STANDARDS))
        for name, spec in body.get("metrics", {}).items():
            _known(spec, {"synonyms", "unit", "scale_hints", "only_in_sources", "aggregation_hint"}, f"{where}.metrics.{name}")
            if "unit" not in spec:
                raise ConfigError(f"{where}.metrics.{name}: missing field 'unit'")
            metrics.append(MetricSpec(profile, name, **spec))
    tickers = []
    for k, entry in enumerate(_known(_read(base, "tickers.yaml"), {"tickers"}, "tickers.yaml").get("tickers", [])):
        where = f"tickers.yaml: tickers[{k}]"
        _known(entry, {"ticker", "name", "e_disclosure_id", "profile", "inn", "ogrn", "use_vision_extraction", "priority_override"}, where)
        entry = {f: v if isinstance(v, bool) else str(v) for f, v in entry.items() if f != "priority_override" and v is not None}
        if entry.get("profile", "non_bank") not in profiles and profiles:
            raise ConfigError(f"{where}: unknown profile {entry['profile']!r}")
        try:
            tickers.append(Ticker(**entry))
        except TypeError as e:
            raise ConfigError(f"{where}: {e}") from e
    events = [EventType(**_known(e, {"code", "display_name", "aliases"}, f"event_types.yaml: [{k}]")) for k, e in enumerate(_known(_read(base, "event_types.yaml"), {"event_types"}, "event_types.yaml").get("event_types", []))]
    if events and "other" not in {e.code for e in events}:
        raise ConfigError("event_types.yaml: 'other' is required")
    rest = {name: _read(base, f"{name}.yaml") for name in ("app", "llm", "ocr") if (base / f"{name}.yaml").exists()}
    return Settings(metrics, priorities, tickers, events, rest)


def spec_table(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame([(m.profile, m.metric_name, m.unit, m.only_in_sources) for m in settings.metrics], "profile string, metric_name string, unit string, only_in_sources array<string>")


def ticker_table(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame([(t.ticker, t.e_disclosure_id, t.name, t.profile, t.use_vision_extraction) for t in settings.tickers], "ticker string, e_disclosure_id string, name string, profile string, use_vision boolean")


def overlap_ids(settings: Settings) -> set[str]:
    """Configured ids without placeholders."""
    return {t.e_disclosure_id for t in settings.tickers} - {PLACEHOLDER, ""}


def masked(data: Any, name: str = "") -> Any:
    """values of secret fields are shown as ***."""
    if isinstance(data, dict):
        return {k: masked(v, str(k)) for k, v in data.items()}
    if isinstance(data, list):
        return [masked(v, name) for v in data]
    return "***" if data not in (None, "") and isinstance(data, str) and SECRET.search(name) else data


def duration(value: str) -> timedelta:
    """a number and s, m, h, d or w."""
    m = re.fullmatch(r"\s*(\d+)\s*([smhdw])\s*", value, re.I)
    if not m:
        raise ConfigError(f"invalid duration {value!r}")
    names = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}
    return timedelta(**{names[m[2].lower()]: int(m[1])})


def answer_schema(settings: Settings, profile: str, standard: str) -> dict:
    """JSON Schema of an answer: the metrics that apply to the profile and standard."""
    names = [m.metric_name for m in settings.metrics if m.profile == profile and (not m.only_in_sources or standard in m.only_in_sources)]

    def closed(properties: dict) -> dict:
        return {"type": "object", "properties": properties, "required": list(properties), "additionalProperties": False}

    item = closed({"value": {"type": ["number", "null"]}, "source_quote": {"type": ["string", "null"]}})
    block = closed(
        {
            "reporting_date": {"type": "string", "pattern": r"^\d{4}-\d{2}-\d{2}$"},
            "period_type": {"type": "string", "enum": list(PERIODS)},
            "reporting_standard": {"type": "string", "enum": list(REPORT_STANDARDS)},
            "currency": {"type": "string", "minLength": 3, "maxLength": 3},
            "unit": {"type": "string", "enum": ["ones", "thousands", "millions", "billions"]},
            "metrics": closed(dict.fromkeys(names, item)),
        }
    )
    return closed({"extractions": {"type": "array", "items": block}})


def system_prompt(settings: Settings, profile: str, standard: str) -> str:
    """deterministic text for a profile and standard; hints on sums only for RSBU."""
    lines = [f"Extract financial metrics of a {profile} issuer from a report under {standard}.", "Give numbers as printed and name their unit; null where the report has none.", "Metrics:"]
    for m in settings.metrics:
        if m.profile == profile and (not m.only_in_sources or standard in m.only_in_sources):
            hint = f" Note: {m.aggregation_hint}" if m.aggregation_hint and standard == "RSBU" else ""
            lines.append(f"- {m.metric_name} ({', '.join(m.synonyms)}); scales: {', '.join(m.scale_hints) or 'any'}.{hint}")
    return "\n".join(lines)


def dump(settings: Settings) -> str:
    return json.dumps(masked({"tickers": len(settings.tickers), "metrics": len(settings.metrics), "event_types": [e.code for e in settings.event_types], **settings.other}), ensure_ascii=False, indent=2, sort_keys=True)


