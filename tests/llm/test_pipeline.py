import re
import zlib

import numpy as np
import pytest

import corpus_pipeline as C
from pyspark.sql import functions as F

from lexforge.llm.shared import settle
from tests.llm.test_op5_decontamination import brute as hits
from tests.llm.test_op10_mixing import tree_budgets
from tests.llm.test_op8_jaccard_join import sets_of

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(spark, sf):
    from lexforge.llm.shared import settle

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(settle(stage(spark, out[-1], sf), "t"))
    return out


def test_stages_keep_the_columns(stages):
    assert all(x.columns == stages[0].columns for x in stages[:-1])


def test_near_copies(stages):
    rows = stages[1].select("doc_id", "text").collect()
    sets = {r.doc_id: sets_of(r.text, 5) for r in rows}
    label = {k: k for k in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    assert sorted(r.doc_id for r in stages[2].select("doc_id").collect()) == sorted({root(k) for k in ids})


def test_contaminated_documents_go(spark, sf, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = " ".join(t for _, t in items)
    before = stages[2].select("doc_id", "text").collect()
    kept = {r.doc_id for r in stages[3].select("doc_id").collect()}
    assert grams and 0 < len(kept) < len(before)
    for r in before[:40] + [r for r in before if r.doc_id not in kept]:
        near = [x for x in items if set(re.findall(r"\w+", x[1].lower())) & set(re.findall(r"\w+", r.text.lower()))]
        assert (r.doc_id not in kept) == (hits(r.text, near, 10)[1] > 0)


def test_tokens(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in stages[4].select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = stages[5].collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens


def test_languages_of_all_rows(stages):
    """Language identification of all rows."""
    from lexforge.llm import language_id

    trees = language_id.fit(stages[0])
    rows = stages[0].select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    bits = trees.code_lengths(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    want = [r.doc_id for r, t, b in zip(rows, texts, bits, strict=True) if any(c.isalpha() for c in r.text or "") and b.min() < 8 * len(t)]
    assert sorted(r.doc_id for r in stages[1].select("doc_id").collect()) == sorted(want)


def test_mixing_reaches_every_budget(stages):
    """Each leaf's tokens against budgets worked out by recursion: short of none, and over it by less than a document."""
    leaf = lambda r: (f"d{int(re.search('[0-9]*$', r.source or '')[0] or 0) % 3}", r.lang or "\x00", r.source or "\x00")
    given = {r.doc_id: (leaf(r), len(re.findall("[^\x20\x09-\x0D]+", r.text or ""))) for r in stages[3].select("doc_id", "text", "lang", "source").collect()}
    leaves, most = {}, {}
    for at, n in given.values():
        leaves[at], most[at] = leaves.get(at, 0) + n, max(most.get(at, 0), n)
    weights = {"d0": 2, "d1": 3, "d2": 4} | {at[1]: 2 for at in leaves} | {"en": 4}
    budget = tree_budgets({at: 2 * n for at, n in leaves.items()}, weights, int(0.75 * sum(leaves.values())))
    taken = dict.fromkeys(leaves, 0)
    for r in stages[4].select("doc_id").collect():
        taken[given[r.doc_id][0]] += given[r.doc_id][1]
    assert all(budget[at] - 1 <= taken[at] < budget[at] + most[at] + 1 for at in leaves)


def test_edge_rows_of_every_stage(spark, sf, docs, no_docs):
    """Nulls, blanks, repeated rows, and columns of names that the stages use themselves."""
    frame = docs.select("doc_id", "text", "lang", "source", *(F.lit(f"my {c}").alias(c) for c in ("digest", "digest_2", "copy", "copies", "n_tokens", "c0", "node", "letters", "_n", "body")))
    frame = settle(frame, "t")
    rows = {name: stage(spark, frame, sf) for name, stage in C.STAGES}
    for name, out in list(rows.items())[:-1]:
        assert out.columns == frame.columns, name
        assert all(r[c] == f"my {c}" for r in out.collect() for c in frame.columns[4:]), name
    ids = {name: sorted((r.doc_id is None, r.doc_id) for r in out.select("doc_id").collect()) for name, out in rows.items()}
    none = (True, None)
    assert ids["language_id"] == [(False, i) for i in (1, 1, 7, 8)] + [none]  # 5 is in French, of which no row that may be learned has a word
    assert ids["ngram_jaccard_join"] == [(False, i) for i in range(1, 9)] + [none]
    assert len(ids["benchmark_decontamination"]) == len(ids["token_output"]) == 10
    assert set(ids["mixing"]) <= set(ids["token_output"])
    empty = no_docs
    for _, stage in C.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0
