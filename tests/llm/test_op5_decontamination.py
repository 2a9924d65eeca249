import random
import re

from lexforge.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        for k in range(max(1, len(b) - window + 1) if b else 0):
            gram = b[k : k + window]
            for i in range(len(w) - len(gram) + 1):
                if w[i : i + len(gram)] == gram:
                    hit.update(range(i, i + len(gram)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def frames(spark, seed=1, n=60):
    rnd = random.Random(seed)
    vocab = ["the", "The", "a1", "é", "x-y", "zz"]
    texts = [" ".join(rnd.choices(vocab, k=rnd.randrange(40))) for _ in range(n)] + [None, "", "..."]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randrange(1, 9)))) for i in range(12)] + [(12, None), (13, ""), (14, "the"), (14, "the the")]
    return texts, items, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force_in_one_and_many_blocks(spark):
    texts, items, docs, benchmark = frames(spark)
    for block in (1_000_000, 6):
        got = {r.doc_id: r for r in D.decontaminate(docs, benchmark, window=4, block_words=block).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute(t, items, 4), (block, i, t)
            assert sum(s.end - s.start for s in got[i].spans) == got[i].n_hit and got[i].contaminated == (got[i].n_hit > 0)


def brute_near(text, items, window, slop):
    """Starts, of each item's different windows, for which all terms stand near their places, but not all exactly."""
    w, count = words(text), 0
    for _, body in items:
        b = words(body)
        for gram in {tuple(b[k : k + window]) for k in range(max(1, len(b) - window + 1) if b else 0)}:
            for start in range(-window - slop, len(w) + slop):
                places = [start + k for k in range(len(gram))]
                near = all(any(w[q] == t for q in range(max(p - slop, 0), min(p + slop + 1, len(w)))) for p, t in zip(places, gram, strict=True))
                exact = all(0 <= p < len(w) and w[p] == t for p, t in zip(places, gram, strict=True))
                count += near and not exact
    return count


def test_proximity_equals_brute_force_however_texts_and_items_are_cut(spark):
    texts, items, docs, benchmark = frames(spark, seed=4)
    texts = texts + ["the a1 zz", "a1 the", "zz zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for slop in (1, 2):
        want = {i: (*brute(t, items, 4)[1:], brute_near(t, items, 4, slop)) for i, t in enumerate(texts)}
        assert sum(n > 0 for *_, n in want.values()) > 10
        for limit, block, parts in ((4 << 20, 1_000_000, 1), (1, 1_000_000, 3), (64, 6, 2), (300, 20, 4)):
            index = D.build_index(docs.repartition(parts), limit=limit)
            got = {r.doc_id: (sum(s.end - s.start for s in r.spans), r["items"], r.n_near) for r in D.search(index, benchmark, window=4, slop=slop, block_words=block).collect()}
            assert got == want, (slop, limit, block)


def test_proximity_does_not_depend_on_other_documents(spark):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for others in ([], ["a b"], ["c c"], ["b b b", "a"]):
        docs = spark.createDataFrame([(0, "b a c")] + [(i + 1, t) for i, t in enumerate(others)], "doc_id long, text string").coalesce(1)
        got = {r.doc_id: r.n_near for r in D.decontaminate(docs, benchmark, slop=1).collect()}
        assert got[0] == brute_near("b a c", [(1, "a b c")], 10, 1) > 0


def test_edge_rows(docs, no_docs, spark):
    benchmark = spark.createDataFrame([(1, "cat sat")], "item_id long, text string")
    rows = D.decontaminate(docs, benchmark).collect()
    assert len(rows) == 10 and sum(r.contaminated for r in rows) == 2
    assert D.decontaminate(no_docs, benchmark).count() == 0
    assert not any(r.contaminated for r in D.decontaminate(docs, benchmark.limit(0)).collect())
