"""Queries over the given tables, one per operator, and their SQL where it exists."""

from __future__ import annotations

from quadweld.llm import (
    collocations,
    conversations,
    decontaminate,
    html_text,
    line_quality,
    mixing,
    packing,
    quality_rules,
    recompression,
    simhash,
    toxicity,
    url_filters,
    warc,
)
from quadweld.llm.tables import read

QUERIES = {
    "op1_warc": lambda spark, d: warc.op1_warc(read(spark, d, "pages")),
    "op2_simhash": lambda spark, d: simhash.op2_simhash(read(spark, d, "documents")),
    "op3_decontaminate": lambda spark, d: decontaminate.op3_decontaminate(
        read(spark, d, "documents"), read(spark, d, "benchmark")
    ),
    "op4_toxicity": lambda spark, d: toxicity.op4_toxicity(read(spark, d, "documents"), read(spark, d, "labels")),
    "op5_html_text": lambda spark, d: html_text.op5_html_text(read(spark, d, "pages")),
    "op6_line_quality": lambda spark, d: line_quality.op6_line_quality(read(spark, d, "documents"), read(spark, d, "labels")),
    "op7_url_filters": lambda spark, d: url_filters.op7_url_filters(read(spark, d, "pages")),
    "op8_quality_rules": lambda spark, d: quality_rules.op8_quality_rules(read(spark, d, "documents")),
    "op9_mixing": lambda spark, d: mixing.op9_mixing(read(spark, d, "documents")),
    "op10_recompression": lambda spark, d: recompression.op10_recompression(read(spark, d, "documents")),
    "op11_packing": lambda spark, d: packing.op11_packing(read(spark, d, "documents")),
    "op12_collocations": lambda spark, d: collocations.op12_collocations(read(spark, d, "documents")),
    "op13_repair": lambda spark, d: conversations.op13_repair(read(spark, d, "conversations")),
}

ORACLES = {
    "op1_warc": warc.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op7_url_filters": url_filters.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_repair": conversations.ORACLE,
}
