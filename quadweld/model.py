"""Table schemas and fixed names shared by every operator.

A quad is one row: subject, predicate, object term and the graph it came from.
The object term is spread over four columns (kind, lexical form, datatype,
language) so that filters and joins stay ordinary column expressions.
"""

from __future__ import annotations

from pyspark.sql import types as T

# An RDF object term, a triple and a quad, as lists of identity columns.
TERM = ["o_kind", "o", "o_dt", "o_lang"]
TRIPLE = ["s", "p", *TERM]
QUAD = [*TRIPLE, "g"]

IRI, BNODE, LITERAL = "iri", "bnode", "lit"

QUADS_SCHEMA = T.StructType(
    [
        T.StructField("src", T.IntegerType()),
        T.StructField("s", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("o_kind", T.StringType()),
        T.StructField("o", T.StringType()),
        T.StructField("o_dt", T.StringType()),
        T.StructField("o_lang", T.StringType()),
        T.StructField("g", T.StringType()),
    ]
)

MAPPING_SCHEMA = "uri STRING, canonical STRING"
URI_SCHEMA = "uri STRING"
POLICY_SCHEMA = (
    "property STRING, function STRING, cardinality STRING, agg_error STRING, "
    "depends_on STRING, params MAP<STRING,STRING>"
)

# Fixed vocabulary.
OWL_SAME_AS = "http://www.w3.org/2002/07/owl#sameAs"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD_DOUBLE = "http://www.w3.org/2001/XMLSchema#double"
XSD_DECIMAL = "http://www.w3.org/2001/XMLSchema#decimal"

# Names of the output graphs and the infix between graph name and number.
DATA_GRAPH, METADATA_GRAPH, GRAPH_NUMBER_INFIX = "data", "metadata", "-"
DEFAULT_GRAPH = "default"

# Default predicates of the metadata graph.
QUALITY_PROPERTY = "urn:quality:quality"
SOURCE_PROPERTY = "urn:quality:sourceGraph"

# Documented effective defaults of a strategy whose fields are not set.
DEFAULT_FUNCTION, DEFAULT_CARDINALITY, DEFAULT_AGG_ERROR = "ALL", "MANYVALUED", "RETURN_ALL"
MANYVALUED, SINGLEVALUED = "MANYVALUED", "SINGLEVALUED"
IGNORE, RETURN_ALL = "IGNORE", "RETURN_ALL"
NESTED = "NestedResourceDescription"

# Distance reaches its maximum of 1 for dates this many seconds apart (366 days).
MAX_DATE_DIFFERENCE = 31_622_400
