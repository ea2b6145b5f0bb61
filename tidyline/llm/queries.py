"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from tidyline.llm import fingerprints, language_id, line_dedup, manifest, mixing, near_dedup, packing, personal_data, quality_model, quality_rules, repeats, secrets, spelling
from tidyline.llm.common import read_documents

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op1_quality_model")
def op1(spark, sf_dir):
    return quality_model.classify(read_documents(spark, sf_dir))


@query("op2_near_dedup")
def op2(spark, sf_dir):
    return near_dedup.near_duplicates(read_documents(spark, sf_dir), size=2, percent=80)


@query("op3_language_id")
def op3(spark, sf_dir):
    return language_id.identify(read_documents(spark, sf_dir))


@query("op4_packing")
def op4(spark, sf_dir):
    return packing.pieces(read_documents(spark, sf_dir))


@query("op5_mixing", mixing.ORACLE)
def op5(spark, sf_dir):
    return mixing.plan(read_documents(spark, sf_dir)).drop("_key")


@query("op6_repeats")
def op6(spark, sf_dir):
    return repeats.digest(read_documents(spark, sf_dir))


@query("op7_line_dedup", line_dedup.ORACLE)
def op7(spark, sf_dir):
    return line_dedup.digest(read_documents(spark, sf_dir))


@query("op8_fingerprints")
def op8(spark, sf_dir):
    return fingerprints.with_edits(read_documents(spark, sf_dir))


@query("op9_secrets")
def op9(spark, sf_dir):
    return secrets.digest(read_documents(spark, sf_dir))


@query("op10_quality_rules", quality_rules.ORACLE)
def op10(spark, sf_dir):
    return quality_rules.verdicts(read_documents(spark, sf_dir))


@query("op11_personal_data")
def op11(spark, sf_dir):
    return personal_data.digest(read_documents(spark, sf_dir))


@query("op12_spelling")
def op12(spark, sf_dir):
    return spelling.variants(read_documents(spark, sf_dir))


@query("op13_manifest", manifest.ORACLE)
def op13(spark, sf_dir):
    return manifest.tampered_proofs(read_documents(spark, sf_dir))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
