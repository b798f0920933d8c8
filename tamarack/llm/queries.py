"""The corpus operators as registered queries over whole tables."""

from __future__ import annotations

from tamarack.llm import (
    chunking,
    exact,
    jaccard,
    merkle,
    mixing,
    periods,
    pii,
    quality,
    reputation,
    sentencepiece_fst,
    toolcalls,
    toxicity,
    wrappers,
)
from tamarack.plans.registry import registry
from tamarack.sources.tables import table

QUERIES, ORACLES, register = registry()


@register("op1_pii")
def op1_pii(spark, sf_dir):
    return pii.op1(table(spark, sf_dir, "documents"))


@register("op2_tool_calls", toolcalls.ORACLE)
def op2_tool_calls(spark, sf_dir):
    return toolcalls.op2(table(spark, sf_dir, "conversations"))


@register("op6_mixing", mixing.ORACLE)
def op6_mixing(spark, sf_dir):
    return mixing.op6(table(spark, sf_dir, "documents"))


@register("op4_exact_dedup", exact.ORACLE)
def op4_exact_dedup(spark, sf_dir):
    return exact.op4(table(spark, sf_dir, "documents"))


@register("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir):
    return sentencepiece_fst.op5(table(spark, sf_dir, "documents"))


@register("op7_quality")
def op7_quality(spark, sf_dir):
    return quality.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    return toxicity.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_fingerprints")
def op9_fingerprints(spark, sf_dir):
    return chunking.op9(table(spark, sf_dir, "documents"))


@register("op10_near_duplicates")
def op10_near_duplicates(spark, sf_dir):
    return jaccard.op10(table(spark, sf_dir, "documents"))


@register("op3_html_text")
def op3_html_text(spark, sf_dir):
    return wrappers.op3(table(spark, sf_dir, "pages"))


@register("op13_url_filters", reputation.ORACLE)
def op13_url_filters(spark, sf_dir):
    return reputation.op13(table(spark, sf_dir, "pages"))


@register("op11_merkle_manifest", merkle.ORACLE)
def op11_merkle_manifest(spark, sf_dir):
    return merkle.op11(table(spark, sf_dir, "documents"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    return periods.op12(table(spark, sf_dir, "documents"))
