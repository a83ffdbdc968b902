"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import functools

from ..session import configure
from . import bpe, chat, collocations, exact_dedup, katz, license_scan, mixing, near_dedup, packing, periodic_runs, quality_classifier, quality_rules, sharding

_ALL = [sharding.op1_kd_shards, mixing.op2_mix, quality_classifier.op3_quality, chat.op4_chat,
        license_scan.op5_licenses, katz.op6_katz, exact_dedup.op7_exact_dedup, near_dedup.op8_near_dedup,
        quality_rules.op9_weak_quality, bpe.op10_byte_bpe, packing.op11_packing, collocations.op12_collocations, periodic_runs.op13_periodic_runs]


def _configured(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        configure(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {f.__name__: _configured(f) for f in _ALL}
ORACLE = {"op2_mix": mixing.OP2_SQL, "op4_chat": chat.OP4_SQL, "op7_exact_dedup": exact_dedup.OP7_SQL, "op12_collocations": collocations.OP12_SQL}
