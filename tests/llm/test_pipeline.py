"""The pipeline stage by stage against plain versions, and the split between it and the library."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from herdloom.llm import language, pii
from herdloom.llm.base import QUERIES, stored
from tests.llm.conftest import SF, rows_of
from tests.llm.test_tables import plain_join
from tests.llm.test_texts import plain_decontamination

STAGES = dict(corpus_pipeline.STAGES)


def test_pipeline_equals_plain_stages(spark, small):
    """Every decision made again without Spark, from the documents to their ids."""
    kept = {r.doc_id: r.text for r in small.collect()}
    model = language.train(language.training_rows(small))
    langs, scores = model.predict(list(kept.values()))
    kept = {i: t for (i, t), lang, s in zip(kept.items(), langs, scores) if lang != "und" and s >= 0.5}
    least = {doc: component for doc, _, component in plain_join(list(kept.items()))}
    kept = {i: t for i, t in kept.items() if least[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {row[0] for row in plain_decontamination(list(kept.items()), items) if row[-1]}
    kept = {i: pii.sanitised_text(t, None) for i, t in kept.items() if i not in bad}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = [(i, library.encode(t, add_special_tokens=False).ids) for i, t in kept.items()]
    assert rows_of(corpus_pipeline.run(spark, SF), "doc_id", "token_ids") == sorted(expected, key=repr)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_edge_rows_and_empty_tables(spark, edge, none, name):
    for df in (edge, none):
        out = stored(STAGES[name](spark, df, SF), "test-stage")
        assert out.count() <= df.count()
        if name != "encode":
            assert out.schema.simpleString() == df.schema.simpleString()


def test_no_personal_data_is_left(spark, small):
    for row in STAGES["remove_personal"](spark, small, SF).collect():
        assert not pii.find_base(row.text)


def test_every_operator_has_its_query():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
