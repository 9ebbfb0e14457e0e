from quadweld.model import LITERAL, QUADS_SCHEMA


def quads(spark, rows):
    """Quads from (s, p, o, g) or (s, p, o_kind, o, g), or with datatype and language."""
    full = []
    for row in rows:
        if len(row) == 4:
            s, p, o, g = row
            full.append((0, s, p, "iri", o, None, None, g))
        elif len(row) == 5:
            s, p, kind, o, g = row
            full.append((0, s, p, kind, o, None, None, g))
        else:
            s, p, kind, o, dt, lang, g = row
            full.append((0, s, p, kind, o, dt, lang, g))
    return spark.createDataFrame(full, QUADS_SCHEMA)


def literals(spark, rows):
    return quads(spark, [(s, p, LITERAL, o, g) for s, p, o, g in rows])


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def as_list(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
