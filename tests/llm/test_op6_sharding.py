import heapq
import random
import zlib
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st

from lexforge.llm import sharding as S


def check(rows, n_shards):
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r)
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(0 <= s < n_shards for s in by_shard)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by_shard.values())
    assert all(len(x) == 1 for x in by_text.values())
    return {s: sum(r["size"] for r in x) for s, x in by_shard.items()}


def test_equals_plain_lpt_when_small(spark):
    rnd = random.Random(1)
    texts = [rnd.choice("abcdefgh") * rnd.randrange(1, 60) for _ in range(80)]
    rows = S.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=5).collect()
    groups = defaultdict(int)
    for t in texts:
        groups[t] += len(t) + 16
    plain = [0] * 5
    for size in sorted(groups.values(), reverse=True):
        k = plain.index(min(plain))
        plain[k] += size
    assert sorted(check(rows, 5).values()) == sorted(plain)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id]) + 16 for r in rows)


def plain_lpt(sizes, shards):
    heap = [(0, k) for k in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, k))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 90)), max_size=12), st.integers(1, 7))
def test_sizes_with_counts_give_the_loads_of_plain_lpt(classes, shards):
    sizes = Counter()
    for size, count in classes:
        sizes[size] += count
    plan = S.lpt(list(sizes.items()), shards)
    assert [int(sum(size * taken[k] for size, taken in plan)) for k in range(shards)] == plain_lpt(sizes.elements(), shards)
    assert all(taken.sum() == sizes[size] and (taken >= 0).all() for size, taken in plan)


def test_many_small_groups_are_plain_lpt(spark, monkeypatch):
    """No group of note, many of one size, and blocks of ranks and slots."""
    monkeypatch.setattr(S, "SLOT_ROWS", 100)
    texts = ["x" * (i % 9) + f" {i:04}" for i in range(3000)]
    rows = S.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=7).collect()
    loads = check(rows, 7)
    assert [loads[k] for k in range(7)] == plain_lpt([len(t) + 16 for t in texts], 7)


def test_a_group_with_a_third_of_all_rows(spark):
    texts = ["copy"] * 500 + [f"text {i}" * (1 + i % 5) for i in range(1000)]
    loads = check(S.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=4).collect(), 4)
    assert [loads[k] for k in range(4)] == plain_lpt([500 * 20, *(len(t) + 16 for t in texts[500:])], 4)


def test_edge_rows(docs, no_docs):
    rows = S.shard_documents(docs, shards=3).collect()
    assert len(rows) == 10 and {r.law for r in rows} == {"bytes"}
    assert all(r["size"] == 16 for r in rows if r.doc_id in (2, 3)) and all(r.grown_shard is None for r in rows)
    check(rows, 3)
    assert S.shard_documents(no_docs).count() == 0
