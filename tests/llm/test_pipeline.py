from __future__ import annotations

import corpus_pipeline
from brute import SF_SMALL, jaccard_components, repeated, words

from eventlake.llm import op1_substring_dedup as op1
from eventlake.llm import op4_jaccard_join as op4
from eventlake.llm import op10_decontaminate as op10


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substring_dedup", "decontamination", "bpe"]


def test_stages_against_plain_python(spark, tmp_path):
    """Each stage's rows are those of its contract on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert out.columns == columns
            kept = {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            assert kept == rows  # all of them are in a learned language
        elif name == "near_duplicates":
            want = jaccard_components(list(rows.items()))
            assert kept == {d: x for d, x in rows.items() if want[d][1] == d}
        elif name == "substring_dedup":
            pairs = list(rows.items())
            units = [words(x) for _, x in pairs]
            flags = repeated(pairs, units, 13)
            assert kept == {d: " ".join(w for w, g in zip(u, go, strict=True) if not g) for (d, _), u, go in zip(pairs, units, flags, strict=True)}
        elif name == "decontamination":
            found = {r.doc_id for r in op10.contaminated(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
            assert found and kept == {d: x for d, x in rows.items() if d not in found}
        else:
            assert {r.doc_id for r in out.collect()} == set(rows)
        if name != "bpe":
            docs, rows = out, kept


def test_stages_keep_other_columns(spark, docs):
    for stage in (op1.stage, op4.stage, op10.stage):
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
