import hashlib

import duckdb

from .conftest import AWKWARD, small

from tradeglass.llm.common import stage_path
from tradeglass.llm.exact_dedup import DigestIndex
from tradeglass.llm.queries import ORACLE, QUERIES


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (str((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest())) for i, t in rows)
    )


def index(spark, buckets=4):
    return DigestIndex(spark, stage_path(spark, "test-index"), buckets)


def test_awkward_rows(llm, awkward):
    assert sorted(str(tuple(r)) for r in index(llm).add(awkward).collect()) == expected(AWKWARD)


def test_later_batches_meet_the_index(llm, documents):
    own = index(llm)
    own.add(documents([(1, "a"), (2, "a"), (3, "b")])).collect()
    second = own.add(documents([(9, "a"), (8, "c"), (7, "c")])).collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in second} == {9: (2, False), 8: (8, True), 7: (8, False)}
    again = own.add(documents([(9, "a"), (8, "c"), (7, "c")])).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in second}
    assert own.rows().count() == 3
    # Another session finds the index by its path.
    llm.sql(f"DROP TABLE {own.name}")
    assert DigestIndex(llm, own.path, 4).rows().count() == 3


def test_index_is_bucketed_and_not_shuffled(llm, documents):
    own = index(llm)
    own.add(documents([(1, "a"), (2, "b")]))
    digests = own.rows().select("digest").repartition(4, "digest")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = digests.join(own.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().sparkPlan().toString()
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan


def test_survivors_and_empty_table(llm, documents, awkward):
    kept = index(llm).survivors(awkward)
    assert kept.columns == awkward.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in AWKWARD})
    assert index(llm).add(documents([])).count() == 0


def test_query_equals_sql(llm):
    found = QUERIES["op9_exact_dedup"](llm, "/root/testdata/sf0.001")
    connection = duckdb.connect()
    connection.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    answer = connection.execute(ORACLE["op9_exact_dedup"])
    columns = [c[0] for c in answer.description]
    assert sorted(map(str, found.select(*columns).toPandas().itertuples(index=False, name=None))) == sorted(map(str, answer.fetchall()))
    assert found.count() == small(llm, "documents").count()
