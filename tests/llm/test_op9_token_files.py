import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexforge.llm import token_files as TF

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_whole_texts():
    rnd = random.Random(1)
    alphabet = "aAbé  '\n\t.,s'tT19ÉñΣ́  #-—<|>中あ🙂İ\x0b\x1c\x85d'll"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(50))) for _ in range(2000)] + ["a<|endoftext|>b", "<|ENDOFTEXT|>", None]
    enc = TF.WordEncoder(PATH)
    assert enc.by_piece
    flat, counts = enc.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for i, e in enumerate(enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert e.ids == flat[ends[i] - counts[i] : ends[i]].tolist(), texts[i]


def test_letters_that_compose_only_in_lower_case():
    """NFC comes before lower case: H and a macron below stay two characters, while h and one are composed."""
    enc = TF.WordEncoder(PATH)
    texts = ["H\u0331 T\u0308 W\u030a Y\u030a J\u030c", "h\u0331 t\u0308 w\u030a y\u030a j\u030c", "e\u0301 =\u0338 <\u0338a a\u0301\u0327 \u0301x", "A\u030a1 \u212b"]
    flat, counts = enc.encode(pa.array(texts))
    whole = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert flat.tolist() == [i for x in whole for i in x] and counts.tolist() == [len(x) for x in whole]


def test_pieces_are_told_from_the_configuration():
    import json

    config = json.loads(TF.WordEncoder(PATH).tokenizer.to_str())
    assert TF.cuts_at_pieces(config)
    for change in ({"normalizer": {"type": "NFKC"}}, {"normalizer": None, "pre_tokenizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}):
        assert not TF.cuts_at_pieces(config | change)


def test_random_access_without_copies(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices(["cat", "dog", "mat", "é", "x1"], k=rnd.randrange(400))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    manifest = TF.write_tokens(frame, TF.scratch(spark, "t"), PATH, length=8).collect()
    for r in manifest:
        reader, flat = TF.SequenceReader(r.base), TF.real_ids(r.base)
        assert len(reader) == -(-r.n_ids // 8) > 3 * TF.BATCH_ROWS // 2
        at = [0, 1, TF.BATCH_ROWS - 1, TF.BATCH_ROWS, len(reader) - 1, *rnd.sample(range(len(reader)), 50)]
        before = pa.total_allocated_bytes()
        views = [reader.sequence(i) for i in at]
        assert pa.total_allocated_bytes() == before  # views of the mapped file
        for i, (ids, mask) in zip(at, views, strict=True):
            own = flat[8 * i : 8 * i + 8]
            assert not ids.flags.owndata and ids[: len(own)].tolist() == own.tolist() and mask.to_pylist() == [True] * len(own) + [False] * (8 - len(own))
        with pytest.raises(IndexError):
            reader.sequence(len(reader))
    empty = TF.write_tokens(frame.limit(0), TF.scratch(spark, "t"), PATH, length=8).collect()
    assert not empty


def test_other_tokenizers_take_the_plain_way():
    enc = TF.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not enc.by_piece
    flat, counts = enc.encode(pa.array(["The  cat", None]))
    assert counts.tolist()[1] == 0 and flat.tolist() == enc.tokenizer.encode("The  cat").ids


@pytest.mark.parametrize("file_ids", [10**9, 40])
def test_round_trip(spark, file_ids):
    texts = [f"Text {i} " * (i % 7) for i in range(60)] + [None]
    frame = spark.createDataFrame(list(enumerate(texts))[::-1], "doc_id long, text string").repartition(3)
    enc = TF.WordEncoder(PATH)
    manifest = TF.write_tokens(frame, TF.scratch(spark, "t"), PATH, length=16, file_ids=file_ids)
    got = {r.doc_id: r for r in TF.read_tokens(manifest, frame.schema["doc_id"].dataType).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = [*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for r in manifest.collect():  # equal-length sequences, and masks that only pad the end
        table = TF.open_stream(r.base + ".arrows").read_all()
        assert table.schema.field("ids").type.list_size == table.schema.field("mask").type.list_size == 16
        assert table.num_rows == -(-r.n_ids // 16)
        mask = table.column("mask").combine_chunks().flatten().to_pylist()
        assert mask == [True] * r.n_ids + [False] * (len(mask) - r.n_ids)


def test_edge_rows(docs, no_docs):
    rows = TF.tokens_roundtrip(docs, PATH).collect()
    assert len(rows) == 10 and sorted(r.start for r in rows)[0] == 0
    assert [r.start for r in rows if r.doc_id is None] == [0] and all(r.n_tokens == 1 for r in rows if r.doc_id in (2, 3, 4))
    assert TF.tokens_roundtrip(no_docs, PATH).count() == 0
