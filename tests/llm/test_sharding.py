import zlib
from collections import defaultdict

from .conftest import AWKWARD, small

from tradeglass.llm.queries import QUERIES
from tradeglass.llm.sharding import shard, write_shards


def check(rows, found, shards):
    assert sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows) == sorted(
        str((r.doc_id, r.size, r.text_crc32)) for r in found
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    return slots


def sizes(found):
    total = defaultdict(int)
    for r in found:
        total[r.shard] += r.size
    return total


def test_awkward_rows(llm, awkward):
    check(AWKWARD, shard(awkward, 3).collect(), 3)


def test_query_is_even_and_keeps_equal_texts_together(llm):
    found = QUERIES["op10_sharding"](llm, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    check(rows, found, 16)
    text = dict(rows)
    homes = defaultdict(set)
    for r in found:
        homes[text[r.doc_id]].add(r.shard)
    assert all(len(own) == 1 for own in homes.values())


def test_sizes_are_near_equal_and_a_hot_group_is_split(llm, documents):
    rows = [(i, "hot copy " * 30) for i in range(600)] + [(1000 + i, f"text {i} " * (i % 23 + 1)) for i in range(1200)]
    found = shard(documents(rows), 8).collect()
    check(rows, found, 8)
    total = sizes(found)
    assert max(total.values()) <= 1.05 * sum(total.values()) / 8
    assert max(total.values()) - min(total.values()) <= 0.1 * sum(total.values()) / 8


def test_one_text_only(llm, documents):
    found = shard(documents([(i, "same") for i in range(400)]), 4).collect()
    assert max(sizes(found).values()) <= 1.3 * 400 * 5 / 4


def test_empty_table_and_files(llm, documents, tmp_path):
    assert shard(documents([]), 4).count() == 0
    write_shards(documents([(i, f"t{i}") for i in range(20)]), str(tmp_path / "out"), 4)
    back = llm.read.parquet(str(tmp_path / "out"))
    assert back.count() == 20 and "shard_id" in back.columns and "text" in back.columns
