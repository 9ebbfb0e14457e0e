import pytest

from quadweld.operators.policy import (
    Rules,
    assign_policy,
    expand_prefix,
    invalid_prefixes,
    property_policy,
)
from quadweld.plans.config import (
    FusionConfig,
    Strategy,
    check_prefixes,
    from_settings,
    from_xml,
    is_valid,
)
from tests.helpers import as_list, as_set, quads

SHOP = "http://shop.example/terms#"
PRICE, STOCK, TITLE = f"{SHOP}price", f"{SHOP}stock", "http://books.example/title"
FULL = f"""<Config>
  <ConflictResolution>
    <ResolutionStrategy function="BEST">
      <Param name="language" value="any"/>
      <Property id="bk:title"/>
    </ResolutionStrategy>
    <ResolutionStrategy function="MEDIAN" cardinality="SINGLEVALUED" aggregationErrorStrategy="IGNORE" dependsOn="sh:stock">
      <Property id="{PRICE}"/>
      <Property id="sh:stock"/>
    </ResolutionStrategy>
    <DefaultStrategy function="VOTE"/>
  </ConflictResolution>
  <Prefixes>
    <Prefix id="sh" namespace="http://shop.example/old#"/>
    <Prefix id="bk" namespace="http://books.example/"/>
    <Prefix id="sh" namespace="{SHOP}"/>
  </Prefixes>
  <DataProcessing>
    <Param name="processResourcesWITHCLASS" value="sh:Item"/>
  </DataProcessing>
</Config>"""


def test_full_configuration():
    config = from_xml(FULL)
    assert config.prefixes["sh"] == SHOP
    assert config.required_class == f"{SHOP}Item"
    assert config.default == Strategy("VOTE")
    middle = Strategy("MEDIAN", "SINGLEVALUED", "IGNORE", STOCK)
    assert config.properties == {
        PRICE: middle,
        STOCK: middle,
        TITLE: Strategy("BEST", params={"language": "any"}),
    }


@pytest.mark.parametrize("text", ["", "  \n", "<Config/>"])
def test_empty_configuration_keeps_unset_fields(text):
    config = from_xml(text)
    assert config.default == Strategy()
    assert (config.prefixes, config.properties, config.required_class) == ({}, {}, None)
    assert is_valid(text)


@pytest.mark.parametrize(
    "text",
    [
        "<Config><XPrefixes/></Config>",
        '<Config><DataProcessing><Param name="enableFileCache" value="false"/></DataProcessing></Config>',
        "<Config>",
        "<Config><Prefixes><Prefix id='a'/></Prefixes></Config>",
        "<Config><ConflictResolution><Other/></ConflictResolution></Config>",
        "<Config><Prefixes><Nonsense id='a' namespace='http://a/'/></Prefixes></Config>",
        "<Config><DataProcessing><Thing name='processResourcesWithClass' value=''/></DataProcessing></Config>",
        "<Config><ConflictResolution><DefaultStrategy><Property id='p'/></DefaultStrategy></ConflictResolution></Config>",
        "<Config><ConflictResolution><ResolutionStrategy><Odd/></ResolutionStrategy></ConflictResolution></Config>",
        "<Config><ConflictResolution><DefaultStrategy cardinality='SINGLE'/></ConflictResolution></Config>",
        "<Config><ConflictResolution><DefaultStrategy aggregationErrorStrategy='FOO'/></ConflictResolution></Config>",
    ],
)
def test_unknown_or_broken_settings_are_rejected(text):
    assert not is_valid(text)


def test_empty_class_is_ignored_and_last_property_wins():
    config = from_settings(
        processing=[("processResourcesWithClass", "")],
        strategies=[
            {"function": "ALL", "properties": ["p", "q"]},
            {"function": "BEST", "properties": ["p"]},
        ],
    )
    assert config.required_class is None
    assert {k: v.function for k, v in config.properties.items()} == {"p": "BEST", "q": "ALL"}
    with pytest.raises(ValueError):
        from_settings(sections=[])
    with pytest.raises(ValueError, match="colour"):
        from_settings(strategies=[{"colour": "red", "properties": ["p"]}])
    with pytest.raises(ValueError, match="cardinality"):
        Strategy(cardinality="singlevalued")


def test_policy_table_and_effective_defaults(spark):
    config = from_xml(FULL)
    table = config.policy(spark)
    assert table.where("property IS NULL").count() == 1 and table.count() == 4
    rows = quads(spark, [("s", p, "o", "g") for p in (PRICE, TITLE, "http://other")])
    ruled = assign_policy(rows, table)
    assert as_set(ruled, "p", "function", "cardinality", "agg_error", "depends_on") == {
        (PRICE, "MEDIAN", "SINGLEVALUED", "IGNORE", STOCK),
        (TITLE, "BEST", "MANYVALUED", "RETURN_ALL", None),
        ("http://other", "VOTE", "MANYVALUED", "RETURN_ALL", None),
    }
    assert ruled.where(f"p = '{TITLE}'").first()["params"] == {"language": "any"}
    # A property strategy does not inherit from the default strategy.
    own = FusionConfig(
        default=Strategy("BEST", "SINGLEVALUED"), properties={TITLE: Strategy()}
    ).policy(spark)
    assert as_set(assign_policy(rows, own), "p", "function", "cardinality") == {
        (PRICE, "BEST", "SINGLEVALUED"),
        (TITLE, "ALL", "MANYVALUED"),
        ("http://other", "BEST", "SINGLEVALUED"),
    }


def test_rules_turn_fields_into_conditions(spark):
    config = FusionConfig(
        default=Strategy(cardinality="SINGLEVALUED"),
        properties={"a": Strategy("BEST"), "b": Strategy("AVG", "SINGLEVALUED")},
    )
    rules = Rules.read(config.policy(spark))
    rows = quads(spark, [("s", p, "o", "g") for p in "abc"])
    assert rules.used("function") == {"ALL", "BEST", "AVG"}
    for name, expected in (("BEST", {"a"}), ("AVG", {"b"}), ("ALL", {"c"})):
        assert {r["p"] for r in rows.where(rules.having("function", name)).collect()} == expected
    single = rows.where(rules.having("cardinality", "SINGLEVALUED"))
    assert {r["p"] for r in single.collect()} == {"b", "c"}
    assert rules.only("function", "BEST").used("cardinality") == {"MANYVALUED"}


def test_prefix_expansion(spark):
    prefixes = spark.createDataFrame(
        [("ex", "http://old/", 1), ("ex", "http://new/", 2), ("", "http://none/", 3)],
        "prefix string, namespace string, position int",
    )
    rows = spark.createDataFrame(
        [("ex:a:b",), ("http://full/x",), ("zz:a",), ("plain",), (":c",)], "p string"
    )
    assert as_set(expand_prefix(rows, "p", prefixes), "p") == {
        ("http://new/a:b",),
        ("http://full/x",),
        ("zz:a",),
        ("plain",),
        ("http://none/c",),
    }


def test_last_strategy_of_a_property_wins(spark):
    rows = spark.createDataFrame(
        [
            (1, ["a", "b"], "ALL", "SINGLEVALUED", None, None, {}),
            (2, ["b"], "BEST", None, None, None, {"k": "v"}),
        ],
        "position int, properties array<string>, function string, cardinality string, "
        "agg_error string, depends_on string, params map<string,string>",
    )
    assert as_list(property_policy(rows).fillna("-"), "property", "function", "cardinality") == [
        ("a", "ALL", "SINGLEVALUED"),
        ("b", "BEST", "-"),
    ]


def test_prefix_validation(spark):
    rows = spark.createDataFrame(
        [("ok", "http://x/"), ("", ""), ("1a", "http://x/"), ("a", "no iri"), ("b c", "http://x/")],
        "prefix string, namespace string",
    )
    assert {r["prefix"] for r in invalid_prefixes(rows).collect()} == {"1a", "a", "b c"}
    check_prefixes(FusionConfig(prefixes={"ok": "http://x/"}), spark)
    with pytest.raises(ValueError):
        check_prefixes(FusionConfig(prefixes={"1a": "http://x/"}), spark)
    assert is_valid(FULL)
