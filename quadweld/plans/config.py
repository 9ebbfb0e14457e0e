"""Settings of a fusion run: a small driver-side record and its policy table."""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quadweld.model import (
    DATA_GRAPH,
    DEFAULT_GRAPH,
    IGNORE,
    MANYVALUED,
    MAX_DATE_DIFFERENCE,
    METADATA_GRAPH,
    OWL_SAME_AS,
    POLICY_SCHEMA,
    QUALITY_PROPERTY,
    RETURN_ALL,
    SINGLEVALUED,
    SOURCE_PROPERTY,
)

# Fixed names: the one processing parameter and the sections of a configuration.
CLASS_PARAMETER = "processResourcesWithClass"
SECTIONS = ("Prefixes", "DataProcessing", "ConflictResolution")


@dataclass(frozen=True)
class Strategy:
    """How conflicts of a property are resolved; unset fields take the defaults.

    Cardinality and error strategy are one of a few names; anything else is an error.
    """

    function: str | None = None
    cardinality: str | None = None
    agg_error: str | None = None
    depends_on: str | None = None
    params: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _check("cardinality", self.cardinality, (MANYVALUED, SINGLEVALUED))
        _check("error strategy", self.agg_error, (IGNORE, RETURN_ALL))


def _check(what: str, value: str | None, known: tuple[str, ...]) -> None:
    if value is not None and value not in known:
        raise ValueError(f"unknown {what}: {value!r}; known are {', '.join(known)}")


@dataclass(frozen=True)
class FusionConfig:
    prefixes: Mapping[str, str] = field(default_factory=dict)
    default: Strategy = Strategy()
    properties: Mapping[str, Strategy] = field(default_factory=dict)
    required_class: str | None = None
    mapped_only: bool = False
    max_output: int | None = None
    link_types: Sequence[str] = (OWL_SAME_AS,)
    preferred: Sequence[str] = ()
    # Rounds of relinking before clustering gives up; they grow with the logarithm of the longest chain.
    max_rounds: int = 60
    agree: float = 4.0
    unknown_score: float = 1.0
    publisher_weight: float = 0.2
    date_span: float = MAX_DATE_DIFFERENCE
    score_property: str = "urn:quality:score"
    publisher_property: str = "urn:quality:publisher"
    publisher_score_property: str = "urn:quality:publisherScore"
    write_metadata: bool = False
    data_graph: str = DATA_GRAPH
    metadata_graph: str = METADATA_GRAPH
    quality_property: str = QUALITY_PROPERTY
    source_property: str = SOURCE_PROPERTY
    # Graph of quads without one, in inputs that declare no graphs.
    default_graph: str = DEFAULT_GRAPH

    def with_options(self, **options: Any) -> FusionConfig:
        return replace(self, **options)

    def strategy_rows(self) -> list[tuple]:
        named = [(p, s) for p, s in self.properties.items()]
        return [
            (p, s.function, s.cardinality, s.agg_error, s.depends_on, dict(s.params))
            for p, s in [(None, self.default), *named]
        ]

    def policy(self, spark: SparkSession) -> DataFrame:
        """The policy table: one row per property and one with a null property."""
        return spark.createDataFrame(self.strategy_rows(), POLICY_SCHEMA)

    def prefix_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            list(self.prefixes.items()), "prefix STRING, namespace STRING"
        )


def _expand(value: str, prefixes: Mapping[str, str]) -> str:
    head, colon, rest = value.partition(":")
    return prefixes[head] + rest if colon and head in prefixes else value


# Settings of a strategy; only those of properties name properties.
STRATEGY_KEYS = {"function", "cardinality", "agg_error", "depends_on", "params", "properties"}


def _strategy(settings: Mapping[str, Any], prefixes: Mapping[str, str]) -> Strategy:
    foreign = set(settings) - STRATEGY_KEYS
    if foreign:
        raise ValueError(f"unknown setting of a strategy: {', '.join(sorted(foreign))}")
    anchor = settings.get("depends_on")
    return Strategy(
        function=settings.get("function"),
        cardinality=settings.get("cardinality"),
        agg_error=settings.get("agg_error"),
        depends_on=None if anchor is None else _expand(anchor, prefixes),
        params=dict(settings.get("params") or {}),
    )


def from_settings(
    prefixes: Iterable[tuple[str, str]] = (),
    processing: Iterable[tuple[str, str]] = (),
    default: Mapping[str, Any] | None = None,
    strategies: Iterable[Mapping[str, Any]] = (),
    **unknown: Any,
) -> FusionConfig:
    """Build a configuration from plain settings, rejecting what is not known.

    Repeated prefixes, parameters and properties take the last setting.
    """
    if unknown:
        raise ValueError(f"unknown section: {', '.join(sorted(unknown))}")
    namespaces = dict(prefixes)
    required = None
    for name, value in processing:
        if name.lower() != CLASS_PARAMETER.lower():
            raise ValueError(f"unknown processing parameter: {name}")
        if value:
            required = _expand(value, namespaces)
    per_property: dict[str, Strategy] = {}
    for settings in strategies:
        chosen = _strategy(settings, namespaces)
        for name in settings["properties"]:
            per_property[_expand(name, namespaces)] = chosen
    return FusionConfig(
        prefixes=namespaces,
        default=_strategy(default or {}, namespaces),
        properties=per_property,
        required_class=required,
    )


# Fixed attribute names of a strategy element and the setting each one gives.
_ATTRIBUTES = {
    "function": "function",
    "cardinality": "cardinality",
    "aggregationErrorStrategy": "agg_error",
    "dependsOn": "depends_on",
}


def _read_strategy(element: ElementTree.Element) -> dict[str, Any]:
    foreign = set(element.attrib) - set(_ATTRIBUTES)
    if foreign:
        raise ValueError(f"unknown attribute of {element.tag}: {', '.join(sorted(foreign))}")
    settings: dict[str, Any] = {_ATTRIBUTES[k]: v for k, v in element.attrib.items()}
    known = ("Param", "Property") if element.tag == "ResolutionStrategy" else ("Param",)
    children = [_child(e, known) for e in element]
    settings["params"] = {e.attrib["name"]: e.attrib["value"] for e in children if e.tag == "Param"}
    settings["properties"] = [e.attrib["id"] for e in children if e.tag == "Property"]
    return settings


def _child(element: ElementTree.Element, known: tuple[str, ...]) -> ElementTree.Element:
    if element.tag not in known:
        raise ValueError(f"unknown element: {element.tag}")
    return element


def from_xml(text: str) -> FusionConfig:
    """Read the XML form of the settings; blank text gives the defaults."""
    if not text.strip():
        return FusionConfig()
    try:
        root = ElementTree.fromstring(text.strip())
        settings: dict[str, Any] = {"strategies": []}
        for section in root:
            if section.tag not in SECTIONS:
                raise ValueError(f"unknown section: {section.tag}")
            if section.tag == "Prefixes":
                settings["prefixes"] = [
                    (e.attrib["id"], e.attrib["namespace"]) for e in (_child(x, ("Prefix",)) for x in section)
                ]
            elif section.tag == "DataProcessing":
                settings["processing"] = [
                    (e.attrib["name"], e.attrib["value"]) for e in (_child(x, ("Param",)) for x in section)
                ]
            else:
                for element in section:
                    if element.tag == "DefaultStrategy":
                        settings["default"] = _read_strategy(element)
                    elif element.tag == "ResolutionStrategy":
                        settings["strategies"].append(_read_strategy(element))
                    else:
                        raise ValueError(f"unknown element: {element.tag}")
    except (ElementTree.ParseError, KeyError) as error:
        raise ValueError(f"configuration cannot be read: {error}") from error
    return from_settings(**settings)


def is_valid(text: str) -> bool:
    """Whether the settings can be read; prefixes are not checked here."""
    try:
        from_xml(text)
    except ValueError:
        return False
    return True


def check_prefixes(config: FusionConfig, spark: SparkSession) -> None:
    """Raise if a prefix or namespace of the configuration is not well formed."""
    from quadweld.operators.policy import invalid_prefixes

    if config.prefixes:
        bad = invalid_prefixes(config.prefix_table(spark)).first()
        if bad is not None:
            raise ValueError(f"invalid prefix definition: {bad['prefix']!r} = {bad['namespace']!r}")
