import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tradeglass.llm import fuzzy_lines, near_dup, quality, secret_scan
from tradeglass.llm.common import stage

from .conftest import AWKWARD
from .test_fuzzy_lines import expected as lines_expected
from .test_near_dup import expected as components_expected
from .test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, apply in pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(apply(llm, docs, SF), "test-pipeline")
        assert after.columns == columns
        kept = {r.doc_id: r.text for r in after.collect()}
        assert all(r.n_chars == len(r.text) for r in after.collect())
        if name == "quality":
            scored = quality.score(docs, quality.train(docs, llm.read.parquet(f"{SF}/labels.parquet")))
            assert kept == {i: t for i, t in before if i in {r.doc_id for r in scored.filter("predicted = 1").collect()}}
        elif name == "lines":
            assert sorted(lines_expected(before)) == sorted(
                str((r.doc_id, r.n_lines, r.n_removed, kept[r.doc_id])) for r in fuzzy_lines.cleaned_lines(docs).collect()
            )
        elif name == "near duplicates":
            assert kept == {i: t for i, t in before if str(i) in {x.rsplit(", ", 1)[1][:-1] for x in components_expected(before)}}
            assert near_dup.near_duplicates(after).select("component_id").distinct().count() == len(kept)
        else:
            assert kept == {i: secret_scan.redact(t, secret_scan.find(t)[1]) for i, t in before}
        docs = after
    tokenizer = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    check([(r.doc_id, r.text) for r in docs.collect()], pipeline.STAGES[-1][1](llm, docs, SF).collect(), tokenizer)


def test_run_and_entry(llm):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"](llm, SF).count() > 0 and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_and_empty_tables(llm, documents, rows):
    docs = documents(rows)
    columns = docs.columns
    for _, apply in pipeline.STAGES[:-1]:
        docs = stage(apply(llm, docs, SF), "test-awkward")
        assert docs.columns == columns
    assert pipeline.STAGES[-1][1](llm, docs, SF).count() >= 0
