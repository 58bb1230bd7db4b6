"""The pipeline's stages on the smallest data and on odd rows, and the registered queries."""

import __spark_entry__ as entry
import corpus_pipeline
from vitrine.llm.common import stored
from vitrine.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.test_duplicates import brute_components


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_take_effect(spark, docs):
    at, kept = docs, [docs]
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF), f"test-{name}")
        kept.append(at)
        if name != "sentencepiece":
            assert at.dtypes == docs.dtypes
    told, lines, joined, mixed, encoded = ({r.doc_id: r.text for r in k.collect()} for k in kept[1:])
    source = {r.doc_id: r.text for r in docs.collect()}
    assert len(told) >= 0.98 * len(source) and told.items() <= source.items()
    assert set(lines) < set(told) and any(lines[i] != told[i] for i in lines)
    want, _ = brute_components(list(lines.items()), 5, 80)
    assert {i for i, c in want.items() if i == c} == set(joined)
    assert mixed.items() <= joined.items() and kept[4].count() > len(mixed)
    assert encoded == mixed


def test_pipeline_runs_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), f"odd-{name}")
        assert "ids" in docs.columns


def test_the_last_stage_searches_for_a_second_segmentation(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, "")], "doc_id long, text string")
    rows = corpus_pipeline.encode_and_decode(spark, docs, SF).collect()
    long = [r for r in rows if r.doc_id == 1]
    assert sorted(r["sample"] for r in long) == [1, 2] and len({tuple(r.ids) for r in long}) == 2
    assert {r.text for r in long} == {"the quick brown fox jumps over the lazy dog"}
    # The threshold of the search makes inclusion scores; without a search all were 1.
    assert all(0 < r.inclusion < 1 for r in long) and [r.text for r in rows if r.doc_id == 2] == [""]
