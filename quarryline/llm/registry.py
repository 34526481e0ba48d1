"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ann, bagminhash, collocations, exact_dedup, fmindex, lyndon, mixing, packing, quality, sharding, simhash, spelling, tokenfiles


def queries() -> dict:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_mixing": mixing.op2_mixing,
        "op3_training_order": tokenfiles.op3_training_order,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_bagminhash": bagminhash.op5_bagminhash,
        "op6_fm_index": fmindex.op6_fm_index,
        "op7_packing": packing.op7_packing,
        "op8_nn_descent": ann.op8_nn_descent,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_lyndon_suffixes": lyndon.op10_lyndon_suffixes,
        "op11_collocations": collocations.op11_collocations,
        "op12_simhash": simhash.op12_simhash,
        "op13_spelling": spelling.op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": sharding.SQL, "op4_exact_dedup": exact_dedup.SQL, "op6_fm_index": fmindex.SQL, "op10_lyndon_suffixes": lyndon.SQL, "op11_collocations": collocations.SQL}
