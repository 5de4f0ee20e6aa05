"""The queries of this subpackage, by name, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline

from . import alignment, decontaminate, language_id, licenses, merkle, neighbours, ngram_join, packing, quality, repeats, secret_ledger, token_files, warc

_QUERIES = {
    "op1_quality_mil": quality.op1_quality_mil,
    "op2_template_windows": decontaminate.op2_template_windows,
    "op3_repeated_bytes": repeats.op3_repeated_bytes,
    "op4_packing": packing.op4_packing,
    "op5_nn_descent": neighbours.op5_nn_descent,
    "op6_license_digests": licenses.op6_license_digests,
    "op7_token_files": token_files.op7_token_files,
    "op8_token_groups": ngram_join.op8_token_groups,
    "op9_secret_ledger": secret_ledger.op9_secret_ledger,
    "op10_language_id": language_id.op10_language_id,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_warc_captures": warc.op13_warc_captures,
    "pipeline": corpus_pipeline.run,
}


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return {
        "op2_template_windows": decontaminate.oracle(),
        "op4_packing": packing.oracle(),
        "op6_license_digests": licenses.oracle(),
        "op11_merkle_manifest": merkle.oracle(),
        "op13_warc_captures": warc.oracle(),
    }
