"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontam, language, neardup, neighbours, packing, repeats, suffixes, surrogates, tokencounts, toxicity
from .common import prepare


def _pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {name: lambda spark, sf_dir, query=query: query(prepare(spark), sf_dir) for name, query in _queries().items()}


def _queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_suffixes": suffixes.op2_suffixes,
        "op3_minhash": neardup.op3_minhash,
        "op4_decontam": decontam.op4_decontam,
        "op5_counts": tokencounts.op5_counts,
        "op6_repeats": repeats.op6_repeats,
        "op7_packing": packing.op7_packing,
        "op8_language": language.op8_language,
        "op9_neighbours": neighbours.op9_neighbours,
        "op10_surrogates": surrogates.op10_surrogates,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_suffixes": suffixes.SQL, "op3_minhash": neardup.SQL, "op4_decontam": decontam.SQL, "op6_repeats": repeats.SQL}
