"""The pipeline's decontamination decides row by row, with or without an id."""

from __future__ import annotations

import corpus_pipeline
from millrace.llm import queries
from tests.llm.conftest import PLAIN, prose

SF = "/root/testdata/sf0.01"


def test_rows_without_an_id(spark):
    items = queries.table(spark, SF, "benchmark").where("length(text) > 60").orderBy("item_id").limit(2).collect()
    held = [prose(80 + k, 20) + " " + r.text + " " + prose(90 + k, 20) for k, r in enumerate(items)]
    rows = [(1, held[0]), (2, prose(81, 50)), (None, held[0]), (None, held[0]), (None, held[1]), (None, prose(82, 50)),
            (None, prose(82, 50)), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], PLAIN)
    kept = corpus_pipeline.decontamination(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(2, prose(81, 50)), (None, prose(82, 50)), (None, prose(82, 50)), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
