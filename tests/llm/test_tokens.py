from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from slowtide.llm import bpe, tokencount
from slowtide.llm.tokenizer import Encoder

ODD = "aaabetionsh 'sdmrlve.,#12²½éßÀÎΣςİ́\u0085\x1c\xa0中文🙂_\n\t"


def texts(n: int) -> list[str]:
    rng = random.Random(3)
    out = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return out + [t + "<|endoftext|>" + t for t in out[: n // 5]]


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def test_counts_and_ids_equal_the_library(word_bpe, library):
    machine, encoder = tokencount.CountTransducer(word_bpe, most_states=500, most_pieces=300), Encoder(word_bpe, most=200)
    for t in texts(1500):
        ids = library.encode(t, add_special_tokens=False).ids
        assert machine.count(t) == len(ids) and encoder.encode(t) == ids
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_state_maps_compose_at_any_cut(word_bpe, library):
    machine, rng = tokencount.CountTransducer(word_bpe), random.Random(4)
    for t in texts(400):
        if "́" in t:  # a cut before a combining mark is no cut between characters
            continue
        cuts = sorted(rng.randint(0, len(t)) for _ in range(3))
        parts = [t[a:b] for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True)]
        assert machine.fold([machine.state_map(p) for p in parts]) == len(library.encode(t, add_special_tokens=False).ids)


def test_joints_are_repaired_at_any_cut(word_bpe, library):
    encoder, rng = Encoder(word_bpe), random.Random(5)
    joiner = bpe.Joiner(encoder, window=16)
    for t in texts(400):
        if "́" in t:
            continue
        cuts = sorted(rng.randint(0, len(t)) for _ in range(3))
        parts = [t[a:b] for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True)]
        assert joiner.join([(p, encoder.encode(p)) for p in parts]) == library.encode(t, add_special_tokens=False).ids


def test_documents_round_trip_and_counts(spark, make, word_bpe, library):
    rng = random.Random(6)
    shared = " ".join("".join(rng.choice("abetions") for _ in range(6)) for _ in range(1500))
    long_text = ("x" * 20_000) + " " + shared * 3
    rows = [(1, shared + " end"), (2, "start of it " + shared), (3, None), (4, ""), (None, shared), (5, long_text), (5, long_text), (6, "no blank" * 9000)]
    docs = make(rows)
    got = bpe.encode_documents(docs, word_bpe, ["n_tokens", "ids"], ["doc_id", "label"])
    want = sorted(((i or -1, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=str)
    assert sorted(((r["doc_id"] or -1, r["ids"]) for r in got.collect()), key=str) == want
    decoded = bpe.decode_documents(got, word_bpe, ["doc_id"]).collect()
    assert sorted(r["decoded"] for r in decoded) == sorted(library.decode(ids, skip_special_tokens=False) for _, ids in want)
    counts = tokencount.token_counts(docs, word_bpe).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in counts) == sorted((i, len(ids)) for i, ids in want)
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in counts)
    assert tokencount.token_counts(make([]), word_bpe).count() == 0
    assert bpe.encode_documents(make([]), word_bpe, ["ids"], ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="clash"):
        bpe.encode_documents(docs.withColumnRenamed("label", "ids"), word_bpe, ["ids"], ["ids"])


def test_texts_of_chunks_travel_once_by_digest(spark, make, word_bpe, library, monkeypatch):
    rng = random.Random(8)
    passage = " ".join("".join(rng.choice("abetions") for _ in range(6)) for _ in range(2000))
    rows = [(k, f"start {k} {passage} end {k}") for k in range(40)] + [(None, passage), (40, None), (3, passage)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (2, 1 << 40):  # every shared chunk is common, or none is
            monkeypatch.setattr(bpe, "COMMON", most)
            got = bpe.encode_documents(make(rows).repartition(5), word_bpe, ["ids"], ["doc_id"])
            plan = got._jdf.queryExecution().executedPlan().toString()
            # By digest the references, and the texts before they are made one; then the parts by row.
            assert plan.count("Exchange hashpartitioning(digest") == 2 and plan.count("Exchange hashpartitioning(row") == 1
            want = sorted(((-1 if i is None else i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows))
            assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"]) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ids_are_packed_in_the_fewest_bytes():
    for most, size in ((1 << 16, 2), ((1 << 16) + 1, 4)):
        ids = [0, 255, 256, most - 1]
        assert len(bpe.packed(ids, most)) == 4 * size and bpe.unpacked(bpe.packed(ids, most), most) == ids
    assert bpe.unpacked(bpe.packed([], 9), 9) == []
