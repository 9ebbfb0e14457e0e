"""The same results in plain SQL for DuckDB, one text per query."""

from __future__ import annotations

from checks import fixtures as fx
from quadweld.model import OWL_SAME_AS, RDF_TYPE

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Common table expressions: name -> (names it needs, text).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "claims": ((), fx.duck(fx.CLAIMS)),
    "links": ((), fx.duck(fx.LINKS)),
    "preferred": ((), fx.duck(fx.PREFERRED)),
    "classes": ((), fx.duck(fx.CLASSES)),
    "meta": ((), fx.duck(fx.SCORES)),
    "visits": ((), fx.duck(fx.ORDERS)),
    "chains": ((), fx.duck(fx.CHAINS)),
    # Clusters by transitive closure over both directions.
    "edges": (("links",), "SELECT s AS a, o AS b FROM links UNION SELECT o, s FROM links"),
    "reach": (
        ("edges",),
        "SELECT a, a AS b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a",
    ),
    "clusters": (("reach",), "SELECT a AS uri, min(b) AS root FROM reach GROUP BY a"),
    "heads": (
        ("clusters", "preferred"),
        "SELECT root, coalesce(min(uri) FILTER (WHERE uri IN (SELECT uri FROM preferred)), min(uri)) "
        "AS canonical FROM clusters GROUP BY root",
    ),
    "mapping": (
        ("clusters", "heads"),
        "SELECT uri, canonical FROM clusters JOIN heads USING (root) WHERE uri <> canonical",
    ),
    # Scores of graphs.
    "own_score": (
        ("meta",),
        "SELECT s AS g, avg(cast(o AS double)) AS x FROM meta "
        "WHERE p = 'http://ex/meta/score' GROUP BY s",
    ),
    "pub_score": (
        ("meta",),
        "SELECT m.s AS g, avg(r.x) AS x FROM meta m JOIN (SELECT s, avg(cast(o AS double)) AS x "
        "FROM meta WHERE p = 'http://ex/meta/publisherScore' GROUP BY s) r ON m.o = r.s "
        "WHERE m.p = 'http://ex/meta/publishedBy' GROUP BY m.s",
    ),
    "scores": (
        ("own_score", "pub_score"),
        "SELECT coalesce(a.g, b.g) AS g, coalesce((1.0::double - 0.2::double) * a.x + 0.2::double * b.x, "
        "a.x, b.x) AS w FROM own_score a FULL JOIN pub_score b ON a.g = b.g",
    ),
    # Distinct claims with weights, before and after merging linked parts.
    "plain": (
        ("claims", "scores"),
        "SELECT DISTINCT c.s, c.p, c.o, c.g, coalesce(x.w, 1.0::double) AS w "
        "FROM claims c LEFT JOIN scores x ON c.g = x.g",
    ),
    "merged": (
        ("claims", "scores", "mapping"),
        "SELECT DISTINCT coalesce(m.canonical, c.s) AS s, c.p, c.o, c.g, coalesce(x.w, 1.0::double) AS w "
        "FROM claims c LEFT JOIN mapping m ON c.s = m.uri LEFT JOIN scores x ON c.g = x.g",
    ),
    "described": (
        ("claims", "classes", "mapping"),
        "SELECT coalesce(m.canonical, q.s) AS res, q.* FROM (SELECT * FROM claims UNION ALL "
        "SELECT * FROM classes) q LEFT JOIN mapping m ON q.s = m.uri",
    ),
    "sizes": (
        ("described",),
        "SELECT res, count(*) AS n_quads, count(DISTINCT g) AS n_graphs FROM described GROUP BY res",
    ),
    "economy": (
        ("described",),
        f"SELECT DISTINCT res FROM described WHERE p = '{RDF_TYPE}' AND o = 'http://ex/class/ECONOMY'",
    ),
}


def steps(value: str) -> str:
    """Rounding of a quality inside the engine."""
    return f"(floor(({value}) * 1e9 + 0.533713::double) / 1e9)"


def six(value: str) -> str:
    return f"(floor(({value}) * 1e6 + 0.50005::double) / 1e6)"


def millionths(column: str) -> str:
    """A number as text of its millionths, if it isn't such a text already (means of prices are)."""
    return (
        f"CASE WHEN p = 'http://ex/p/price' THEN {column} ELSE coalesce("
        f"floor(try_cast({column} AS double) * 1e6 + 0.50005::double)::bigint::varchar, {column}) END"
    ).replace("p = ", f"{column.rpartition('.')[0]}.p = " if "." in column else "p = ")


def quality(base: str, conf: str, others: str) -> str:
    first = f"(({base}) * (1.0::double - ({conf})))"
    return steps(f"{first} + (1.0::double - {first}) * least(1.0::double, ({others}) / 4.0::double)")


def values_part(source: str) -> str:
    return (
        f"SELECT s, p, o, count(*) AS n_sources, max(w) AS w_max, sum(w) AS w_sum FROM {source} "
        "GROUP BY s, p, o"
    )


def dot(a: str, b: str) -> str:
    """Product of the counts of character pairs of two texts."""
    pairs = "list_transform(range(1, length({0}) + 2), lambda i: substr('^' || {0} || '$', i, 2))"
    return (
        f"list_sum(list_transform({pairs.format(a)}, lambda x: "
        f"len(list_filter({pairs.format(b)}, lambda y: y = x))))::double"
    )


def distance(a: str, b: str) -> str:
    num = f"regexp_matches({{}}, '{NUMBER}')"
    date = "regexp_matches({}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
    na, nb, da, db = num.format(a), num.format(b), date.format(a), date.format(b)
    xa, xb = f"try_cast({a} AS double)", f"try_cast({b} AS double)"
    ta, tb = f"epoch(try_cast({a} AS timestamp))", f"epoch(try_cast({b} AS timestamp))"
    return (
        f"CASE WHEN {a} = {b} THEN 0.0::double "
        f"WHEN {na} AND {nb} THEN CASE WHEN greatest(abs({xa}), abs({xb})) = 0 THEN 0.0::double "
        f"ELSE least(1.0::double, abs({xa} - {xb}) / greatest(abs({xa}), abs({xb}))) END "
        f"WHEN {da} AND {db} THEN least(1.0::double, abs({ta} - {tb}) / 31622400.0::double) "
        f"WHEN NOT {na} AND NOT {nb} AND NOT {da} AND NOT {db} THEN "
        f"greatest(0.0::double, 1.0::double - {dot(a, b)} / sqrt({dot(a, a)} * {dot(b, b)})) ELSE 1.0::double END"
    )


def judged(values: str, single: str) -> str:
    """Values with their quality; ``single`` is the condition for SINGLEVALUED."""
    return (
        f"SELECT v.*, {quality('v.w_max', 'coalesce(c.conf, 0.0::double)', 'v.w_sum - v.w_max')} AS quality "
        f"FROM {values} v LEFT JOIN (SELECT a.s, a.p, a.o, CASE WHEN sum(b.w_sum) > 0 THEN "
        f"sum(b.w_sum * ({distance('a.o', 'b.o')})) / sum(b.w_sum) ELSE 0.0::double END AS conf "
        f"FROM {values} a JOIN {values} b ON a.s = b.s AND a.p = b.p WHERE {single.format('a.p')} "
        "GROUP BY a.s, a.p, a.o) c ON v.s = c.s AND v.p = c.p AND v.o = c.o"
    )


#: Parts that many others read.
ONCE = {"clusters", "mapping", "merged", "described", "economy"}


def compose(final: str, *needs: str, **local: str) -> str:
    """WITH clause holding the named parts, their needs and local parts in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in PARTS[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    texts = [f"{n} AS {'MATERIALIZED ' * (n in ONCE)}({PARTS[n][1]})" for n in order]
    texts += [f"{n} AS ({text})" for n, text in local.items()]
    return f"WITH RECURSIVE {', '.join(texts)} {final}" if texts else final


SINGLE = "{} IN ('http://ex/p/price', 'http://ex/p/flag', 'http://ex/p/qty', 'http://ex/p/shipped')"
NUMERIC = f"regexp_matches(o, '{NUMBER}')"


def average(source: str, single: bool = True) -> str:
    """Mean of the numeric claims of each cluster, millionths as text."""
    cents = "sum(cast(o AS decimal(18,2)) * 100)::hugeint"
    micro = f"floor({cents} / count(*)::double * 10000 + 0.50005::double)::bigint"
    mean = "m.mean"
    gap = f"CASE WHEN {mean} = 0 AND x = 0 THEN 0.0::double ELSE least(1.0::double, abs({mean} - x) / greatest(abs({mean}), abs(x))) END"
    conf = f"CASE WHEN sum(c.w) > 0 THEN sum(c.w * ({gap})) / sum(c.w) ELSE 0.0::double END"
    return (
        "SELECT m.s, m.p, m.o, m.n_sources, "
        f"{quality('m.base', conf if single else '0.0::double', '0.0::double')} AS quality "
        f"FROM (SELECT s, p, {micro}::varchar AS o, count(DISTINCT g) AS n_sources, "
        f"avg(w) AS base, sum(cast(o AS double)) / count(*) AS mean FROM {source} WHERE {NUMERIC} "
        f"GROUP BY s, p) m JOIN (SELECT s, p, cast(o AS double) AS x, w FROM {source} WHERE {NUMERIC}) c "
        "ON m.s = c.s AND m.p = c.p GROUP BY m.s, m.p, m.o, m.n_sources, m.base"
    ).replace("cast(o AS decimal(18,2))", "cast(c0.o AS decimal(18,2))").replace(
        f"FROM {source} WHERE {NUMERIC} GROUP BY", f"FROM {source} c0 WHERE {NUMERIC.replace('(o,', '(c0.o,')} GROUP BY"
    ).replace("sum(cast(o AS double)) / count(*)", "sum(cast(c0.o AS double)) / count(*)")


BEST = (
    "SELECT * FROM {0} QUALIFY row_number() OVER "
    "(PARTITION BY s, p ORDER BY quality DESC, n_sources DESC, o) = 1"
)

FUSED_VALUES = {
    "vals": values_part("merged"),
    "flags": "SELECT * FROM vals WHERE p = 'http://ex/p/flag'",
    "flags_q": judged("flags", "{} IS NOT NULL"),
    "best": BEST.format("flags_q"),
    "rest": f"SELECT *, {quality('w_max', '0.0::double', 'w_sum - w_max')} AS quality FROM vals "
    "WHERE p NOT IN ('http://ex/p/flag', 'http://ex/p/price')",
    "prices": "SELECT * FROM merged WHERE p = 'http://ex/p/price'",
    "means": average("prices"),
    "fused": "SELECT s, p, o, n_sources, quality FROM best UNION ALL "
    "SELECT s, p, o, n_sources, quality FROM rest UNION ALL "
    "SELECT s, p, o, n_sources, quality FROM means",
}

# Claims about dependent properties from the pair that the price of a part selects.
ANCHORED = {
    "keyed": "SELECT DISTINCT coalesce(m.canonical, c.s) AS s, c.p, c.o, c.g, c.s AS s0, "
    "coalesce(x.w, 1.0::double) AS w FROM claims c LEFT JOIN mapping m ON c.s = m.uri "
    "LEFT JOIN scores x ON c.g = x.g",
    "price_vals": values_part("merged WHERE p = 'http://ex/p/price'"),
    "price_q": judged("price_vals", "{} IS NOT NULL"),
    "picks": "SELECT k.s, k.s0, k.g FROM keyed k JOIN price_q q ON k.s = q.s AND k.p = q.p AND k.o = q.o "
    "QUALIFY row_number() OVER (PARTITION BY k.s ORDER BY q.quality DESC, k.w DESC, k.g, k.s0) = 1",
    "followed": "SELECT DISTINCT k.s, k.p, k.o, k.g FROM keyed k LEFT JOIN picks x ON k.s = x.s "
    "WHERE k.p NOT IN ('http://ex/p/price', 'http://ex/p/discount') "
    "OR x.s IS NULL OR (k.s0 = x.s0 AND k.g = x.g)",
}

ALL_MERGED = {"vals": values_part("merged")}
WITH_QUALITY = f"*, {quality('w_max', '0.0::double', 'w_sum - w_max')} AS quality"

ORACLES: dict[str, str] = {
    "a1_scan_quads": compose(
        "SELECT s, p, o, g FROM (SELECT * FROM claims UNION ALL SELECT * FROM classes) WHERE g IN "
        "(SELECT 'http://ex/g/' || cast(s_suppkey AS varchar) FROM supplier WHERE s_acctbal > 0)",
        "claims",
        "classes",
    ),
    "a2_union_inputs": compose("SELECT DISTINCT s, p, o, g FROM claims", "claims"),
    "a3_scan_links": compose(
        f"SELECT s, o FROM (SELECT * FROM links UNION ALL SELECT * FROM classes) "
        f"WHERE p = '{OWL_SAME_AS}' AND s <> o",
        "links",
        "classes",
    ),
    "a4_scan_metadata": compose("SELECT DISTINCT s, p, o, g FROM meta", "meta"),
    "a5_scan_canonical": compose("SELECT DISTINCT uri FROM preferred", "preferred"),
    "a6_fill_graph": "SELECT 'http://ex/part/' || cast(p_partkey AS varchar) AS s, "
    "'http://ex/class/' || p_type AS o, CASE WHEN p_size % 2 = 0 THEN 'http://ex/g/catalog' "
    "ELSE 'http://ex/g/first' END AS g FROM part",
    "a7_load_stats": compose("SELECT g, count(*) AS n FROM claims GROUP BY g", "claims"),
    "b1_expand_prefix": compose(
        "SELECT s, CASE WHEN p = 'http://ex/p/flag' THEN 'zz:flag' ELSE p END AS p, o FROM claims",
        "claims",
    ),
    "b3_property_policy": "SELECT property, arg_max(function, position) AS function, "
    "arg_max(cardinality, position) FILTER (WHERE last) AS cardinality, "
    "arg_max(depends_on, position) AS depends_on, arg_max(size, position) AS size FROM "
    "(SELECT *, position = max(position) OVER (PARTITION BY property) AS last FROM "
    "(SELECT p_partkey AS position, unnest(['http://ex/p/' || p_brand, 'http://ex/p/' || p_type]) AS property, "
    "CASE WHEN p_size > 25 THEN 'BEST' ELSE 'AVG' END AS function, "
    "CASE WHEN p_size > 10 THEN 'SINGLEVALUED' END AS cardinality, 'http://ex/p/' || p_name AS depends_on, "
    "cast(p_size AS varchar) AS size FROM part)) GROUP BY property",
    "b8_validate_policy": "SELECT prefix, namespace FROM ("
    "SELECT n_name AS prefix, 'http://ex/n/' || cast(n_nationkey AS varchar) AS namespace FROM nation "
    "UNION ALL SELECT s_name, 'http://ex/s/' || cast(s_suppkey AS varchar) FROM supplier "
    "UNION ALL SELECT 'p' || cast(p_partkey AS varchar), 'http://ex/' || p_name FROM part "
    "UNION ALL SELECT '', '' FROM nation) "
    "WHERE (prefix <> '' AND NOT regexp_matches(prefix, '^[A-Za-z_][A-Za-z0-9_.-]*$')) "
    "OR (namespace <> '' AND (NOT regexp_matches(namespace, '^[A-Za-z][A-Za-z0-9+.-]*:') "
    "OR regexp_matches(namespace, '[\\s<>\"{}|^`\\\\]')))",
    "c1_preferred_uris": compose(
        "SELECT uri FROM preferred UNION SELECT 'http://ex/p/price' UNION SELECT 'http://ex/p/flag' "
        "UNION SELECT 'http://ex/part/0'",
        "preferred",
    ),
    "c2_canonical_map": compose("SELECT uri, canonical FROM mapping", "mapping"),
    "c2_canonical_map_chains": compose(
        "SELECT a AS uri, min(b) AS canonical FROM walk GROUP BY a HAVING a <> min(b)",
        "chains",
        either="SELECT s AS a, o AS b FROM chains UNION SELECT o, s FROM chains",
        walk="SELECT a, a AS b FROM either UNION SELECT w.a, e.b FROM walk w JOIN either e ON w.b = e.a",
    ),
    "c3_save_canonical": compose("SELECT DISTINCT canonical AS uri FROM mapping", "mapping"),
    "c4_map_terms": compose(
        "SELECT coalesce(m.canonical, c.s) AS s, coalesce(n.canonical, c.p) AS p, coalesce(k.canonical, c.o) AS o, c.g "
        "FROM (SELECT * FROM claims UNION ALL SELECT * FROM visits) c LEFT JOIN mapping m ON c.s = m.uri "
        "LEFT JOIN mapping n ON c.p = n.uri LEFT JOIN mapping k ON c.o = k.uri AND c.o_kind = 'iri'",
        "claims",
        "visits",
        "mapping",
    ),
    "c5_alternatives": compose(
        "SELECT canonical, uri, count(*) OVER (PARTITION BY root) AS n FROM clusters JOIN heads USING (root)",
        "heads",
    ),
    "d1_describe": compose("SELECT * FROM sizes", "sizes"),
    "d2_nest": compose(
        "SELECT res, s, p, o FROM placed UNION ALL SELECT r.res, c.s, c.p, c.o FROM "
        "(SELECT DISTINCT p.res, coalesce(m.canonical, p.o) AS child FROM placed p LEFT JOIN mapping m ON p.o = m.uri "
        "WHERE p.p = 'http://ex/p/placedBy') r JOIN placed c ON r.child = c.res WHERE r.res <> r.child",
        "visits",
        "mapping",
        placed="SELECT coalesce(m.canonical, v.s) AS res, v.* FROM visits v LEFT JOIN mapping m ON v.s = m.uri",
    ),
    "d3_require_class": compose(
        "SELECT * FROM sizes WHERE res IN (SELECT res FROM economy)", "sizes", "economy"
    ),
    "d4_mapped_only": compose(
        "SELECT * FROM sizes WHERE res IN (SELECT canonical FROM mapping)", "sizes"
    ),
    "d5_all_filters": compose(
        "SELECT * FROM sizes WHERE res IN (SELECT res FROM economy) "
        "AND res IN (SELECT canonical FROM mapping)",
        "sizes",
        "economy",
    ),
    "d6_max_output": compose(
        "SELECT s, p, o, g FROM (SELECT DISTINCT s, p, o, g FROM claims) ORDER BY s, p, o, g LIMIT 1000",
        "claims",
    ),
    "d6_max_output_large": compose(
        "SELECT s, p, o, g FROM (SELECT DISTINCT s, p, o, g FROM claims) ORDER BY s, p, o, g LIMIT 100001",
        "claims",
    ),
    "e1_assign_policy": compose(
        "SELECT p, CASE p WHEN 'http://ex/p/price' THEN 'AVG' WHEN 'http://ex/p/flag' THEN 'BEST' "
        "ELSE 'ALL' END AS function, CASE p WHEN 'http://ex/p/flag' THEN 'MANYVALUED' "
        "ELSE 'SINGLEVALUED' END AS cardinality, CASE p WHEN 'http://ex/p/price' THEN 'IGNORE' "
        "ELSE 'RETURN_ALL' END AS agg_error, CASE p WHEN 'http://ex/p/price' THEN 'http://ex/p/price' END "
        "AS depends_on, count(*) AS n FROM claims GROUP BY p",
        "claims",
    ),
    "e2_conflict_clusters": compose(
        "SELECT s, p, count(*) AS n_members, count(DISTINCT o) AS n_values FROM merged GROUP BY s, p",
        "merged",
    ),
    "e2_tagged_values": "SELECT s, p, CASE WHEN o_kind = 'bnode' THEN '_:' || input || ':' || substr(o, 3) ELSE o END AS o, "
    f"o_dt, o_lang, count(DISTINCT g) AS n_sources FROM ({fx.duck(fx.TAGGED)}) t, (VALUES ('1'), ('2')) i(input) "
    "GROUP BY ALL",
    "e3_sources": compose("SELECT DISTINCT s, p, o, g FROM merged", "merged"),
    "e3_source_lists": compose(
        "SELECT s, p, o, count(*) OVER (PARTITION BY s, p, o) AS n_sources, g FROM merged", "merged"
    ),
    "e6_depends_on": compose(
        "SELECT s, p, o, count(*) AS n_sources FROM followed GROUP BY s, p, o",
        "claims",
        "merged",
        **ANCHORED,
    ),
    "e7_result_graph": compose(
        "SELECT DISTINCT s, p, o, 'http://ex/result/fused/' AS g FROM merged", "merged"
    ),
    "e9_source_quality": compose(
        f"SELECT x.g, {six('coalesce(scores.w, 1.0::double)')} AS score FROM "
        "(SELECT 'http://ex/g/' || cast(s_suppkey AS varchar) AS g FROM supplier) x "
        "LEFT JOIN scores ON x.g = scores.g",
        "scores",
    ),
    "e10_value_quality": compose(
        f"SELECT s, p, o, {six('quality')} AS quality FROM ruled",
        "plain",
        vals=values_part("plain"),
        ruled=judged("vals", SINGLE),
    ),
    "e10_value_quality_merged": compose(
        f"SELECT s, p, o, {six('quality')} AS quality FROM ruled",
        "merged",
        vals=values_part("merged"),
        ruled=judged("vals", SINGLE),
    ),
    "e11_distance": compose(
        f"SELECT v.s, v.p, v.o AS a, m.b, {six(distance('v.o', 'm.b'))} AS d FROM vals v "
        "JOIN (SELECT s, p, min(o) AS b FROM vals GROUP BY s, p) m ON v.s = m.s AND v.p = m.p",
        "claims",
        vals="SELECT DISTINCT s, p, o FROM claims",
    ),
    "e12_all": compose(
        f"SELECT s, p, o, n_sources, {six('quality')} AS quality FROM (SELECT {WITH_QUALITY} FROM vals)",
        "merged",
        **ALL_MERGED,
    ),
    "e13_best": compose(
        f"SELECT s, p, o, n_sources, {six('quality')} AS quality FROM best",
        "plain",
        vals=values_part("plain"),
        ruled=judged("vals", SINGLE),
        best=BEST.format("ruled"),
    ),
    "e14_avg_ignore": compose(
        f"SELECT s, p, o, n_sources, {six('quality')} AS quality FROM means",
        "plain",
        means=average("plain"),
    ),
    "e14_avg_return_all": compose(
        f"SELECT s, p, o, n_sources, {six('quality')} AS quality FROM (SELECT s, p, o, n_sources, quality "
        f"FROM means UNION ALL SELECT s, p, o, n_sources, quality FROM ruled WHERE NOT {NUMERIC})",
        "plain",
        means=average("plain"),
        vals=values_part("plain"),
        ruled=judged("vals", "{} IS NOT NULL"),
    ),
    "e15_nested": compose(
        f"SELECT v.s, v.p, v.o, {six('coalesce(k.q, v.quality)')} AS quality FROM vals v LEFT JOIN "
        f"(SELECT s, {steps('avg(quality)')} AS q FROM vals GROUP BY s) k "
        "ON v.p = 'http://ex/p/placedBy' AND v.o = k.s",
        "visits",
        "clusters",
        # Customer 3 is preferred, and so is its property's own strategy.
        names="SELECT c.uri, CASE WHEN r.uri IS NULL THEN c.root ELSE r.uri END AS canonical FROM clusters c "
        "LEFT JOIN (SELECT root, uri FROM clusters WHERE uri IN ('http://ex/customer/3', 'http://ex/p/placedBy')) r "
        "ON c.root = r.root",
        placed="SELECT coalesce(m.canonical, v.s) AS s, coalesce(n.canonical, v.p) AS p, coalesce(k.canonical, v.o) AS o, v.g "
        "FROM visits v LEFT JOIN names m ON v.s = m.uri LEFT JOIN names n ON v.p = n.uri "
        "LEFT JOIN names k ON v.o = k.uri AND v.o_kind = 'iri'",
        vals=f"SELECT *, {quality('0.5::double', '0.0::double', '0.5::double * n - 0.5::double')} AS quality "
        "FROM (SELECT s, p, o, count(DISTINCT g) AS n FROM placed GROUP BY s, p, o)",
    ),
    "f1_write_data": compose("SELECT DISTINCT s, p, o, 'data' AS g FROM merged", "merged"),
    "f2_write_with_metadata": compose(
        "SELECT s, p, o, 'data-' || k::varchar AS g FROM numbered UNION ALL "
        "SELECT 'data-' || k::varchar, 'urn:quality:quality', "
        "floor(quality * 1e6 + 0.50005::double)::bigint::varchar, 'metadata' FROM numbered UNION ALL "
        "SELECT 'data-' || k::varchar, 'urn:quality:sourceGraph', m.g, 'metadata' FROM numbered n "
        "JOIN merged m ON n.s = m.s AND n.p = m.p AND n.o = m.o UNION ALL "
        "SELECT DISTINCT s, p, o, 'data' FROM classes",
        "merged",
        "classes",
        **ALL_MERGED,
        numbered=f"SELECT {WITH_QUALITY}, row_number() OVER (ORDER BY s, p, o) AS k FROM vals",
    ),
    "f4_noop": compose(
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT s, p FROM claims)) AS clusters, "
        "(SELECT count(*) FROM (SELECT DISTINCT s, p, o FROM merged)) AS n",
        "merged",
    ),
    "f6_graph_override": compose(
        "SELECT DISTINCT s, p, o, 'http://ex/out' AS g FROM claims", "claims"
    ),
    "g1_fuse": compose(
        f"SELECT f.s, f.p, {millionths('f.o')} AS o, {six('f.quality')} AS quality, x.g FROM fused f JOIN ("
        "SELECT s, p, o, g FROM merged WHERE p <> 'http://ex/p/price' UNION ALL "
        "SELECT DISTINCT m.s, m.p, m.o, c.g FROM means m JOIN prices c ON m.s = c.s) x "
        "ON f.s = x.s AND f.p = x.p AND f.o = x.o",
        "merged",
        **FUSED_VALUES,
    ),
    "g1_fuse_filtered": compose(
        f"SELECT s, p, {millionths('o')} AS o, n_sources, {six('quality')} AS quality FROM (SELECT * FROM fused UNION ALL "
        f"SELECT DISTINCT res, p, o, 1, {quality('1.0::double', '0.0::double', '0.0::double')} "
        f"FROM described WHERE p = '{RDF_TYPE}') WHERE s IN (SELECT res FROM economy) "
        "AND s IN (SELECT canonical FROM mapping)",
        "merged",
        "economy",
        **FUSED_VALUES,
    ),
}


# Further functions: all over the unmerged claims, MANYVALUED, unusable values ignored.
ALONE = f"SELECT *, {quality('w_max', '0.0::double', 'w_sum - w_max')} AS quality FROM vals"
ROW = f"SELECT s, p, o, n_sources, {six('quality')} AS quality FROM"


def first_by(order: str, where: str = "true", count: int = 1) -> str:
    return compose(
        f"{ROW} (SELECT * FROM judged WHERE {where} QUALIFY row_number() OVER "
        f"(PARTITION BY s, p ORDER BY {order}) <= {count})",
        "plain",
        vals=values_part("plain"),
        judged=ALONE,
    )


def computed(number: str) -> str:
    return compose(
        f"SELECT s, p, floor({number}::double * 1e6 + 0.50005::double)::bigint::varchar AS o, "
        f"count(DISTINCT g) AS n_sources, {six(steps('avg(w)'))} AS quality FROM plain WHERE {NUMERIC} GROUP BY s, p",
        "plain",
    )


def kept(where: str) -> str:
    return compose(
        f"{ROW} judged v WHERE {where}", "plain", vals=values_part("plain"), judged=ALONE
    )


ORACLES |= {
    "e18_any": first_by("o"),
    "e18_min": first_by("cast(o AS double), o", NUMERIC),
    "e18_max": first_by("-cast(o AS double), o", NUMERIC),
    "e18_median": computed("median(cast(o AS double))"),
    "e18_sum": computed("sum(cast(o AS decimal(18,2)))"),
    "e18_longest": first_by("-length(o), o"),
    "e18_shortest": first_by("length(o), o"),
    "e18_vote": first_by("-n_sources, o"),
    "e18_weighted_vote": first_by(f"-{steps('w_sum')}, o"),
    "e18_top_n": first_by("quality DESC, n_sources DESC, o", count=3),
    "e18_threshold": kept("quality >= 0.8"),
    "e18_choose_source": kept(
        "EXISTS (SELECT 1 FROM plain c WHERE c.s = v.s AND c.p = v.p AND c.o = v.o "
        "AND c.g = 'http://ex/g/3')"
    ),
    "e18_best_source": kept(
        "EXISTS (SELECT 1 FROM plain c JOIN (SELECT s, p, g FROM plain QUALIFY row_number() OVER "
        "(PARTITION BY s, p ORDER BY w DESC, g) = 1) b ON c.s = b.s AND c.p = b.p AND c.g = b.g "
        "WHERE c.s = v.s AND c.p = v.p AND c.o = v.o)"
    ),
    "e18_most_recent": first_by("o DESC", "p = 'http://ex/p/shipped'"),
    "e18_concat": compose(
        f"SELECT s, p, string_agg(DISTINCT o, ' ' ORDER BY o) AS o, count(DISTINCT g) AS n_sources, "
        f"{six(steps('avg(w)'))} AS quality FROM plain GROUP BY s, p",
        "plain",
    ),
    "e18_concat_parts": compose(
        "SELECT s, p, \"start\" // 24 AS part, min(\"start\") AS \"start\", string_agg(o, '|' ORDER BY o) AS text FROM ("
        "SELECT s, p, o, (sum(length(o) + 1) OVER (PARTITION BY s, p ORDER BY o ROWS UNBOUNDED PRECEDING) "
        "- length(o) - 1)::bigint AS \"start\" FROM (SELECT DISTINCT s, p, o FROM plain)) GROUP BY s, p, \"start\" // 24",
        "plain",
    ),
    "e18_none": compose(
        f"SELECT s, p, o, n_sources, {six(steps('w_max'))} AS quality FROM vals",
        "plain",
        vals=values_part("plain"),
    ),
}
