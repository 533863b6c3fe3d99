from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from slowtide.llm import chat, fingerprint, language, lines, mixing


def test_lines_of_one_host(spark):
    rows = [(k, "menu\nown %d\n\nmenu" % k, "h", 1) for k in range(6)] + [(6, None, "h", 1), (7, "", "h", 1), (8, "menu", None, 1), (9, "menu", "small", 1)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, _line int")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in lines.drop_boilerplate_lines(df, 0.5, 3).collect()}
    assert got[0] == ("own 0\n", 4, 2) and got[6] == (None, 0, 0) and got[7] == ("", 1, 0)
    assert got[8] == ("menu", 1, 0) and got[9] == ("menu", 1, 0) and len(got) == 10
    assert lines.drop_boilerplate_lines(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="clash"):
        lines.drop_boilerplate_lines(df.withColumn("N_LINES", F.lit(1)))


def test_mix_reaches_target_shares(spark):
    rows = [(k, "abcd", "big") for k in range(4000)] + [(10_000 + k, "abcd", "small") for k in range(400)] + [(1, None, "empty"), (2, "xy", None), (None, "xy", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, weights={"big": 1.0, "small": 1.0, "empty": 1.0})
    n = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert n["big"] == pytest.approx(1467, rel=0.15) and n["small"] == pytest.approx(1467, rel=0.15) and None not in n
    keys = [r["shuffle_key"] for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert mixing.mix(df.limit(0)).count() == 0
    # A mean of a thousand neither underflows nor drifts.
    rare = spark.createDataFrame([(k, "a", "rare") for k in range(20)] + [(100, "a" * 20_000, "huge")], "doc_id long, text string, source string")
    many = mixing.mix(rare, weights={"rare": 1.0}).count()
    assert many == pytest.approx(20_020, rel=0.05)


def test_rows_without_id_and_repeated_rows_draw_for_themselves(spark):
    rows = [(None, f"t{k:03d}", "no id") for k in range(600)] + [(None, "same", "no id") for _ in range(600)] + [(5, "copy", "one id") for _ in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = mixing.mix(df, weights={"no id": 1.0, "one id": 3.0}, seed=3)
    n = {(r["source"], r["same"]): r["n"] for r in out.groupBy("source", (F.col("text") == "same").alias("same")).agg(F.count("*").alias("n")).collect()}
    assert n["no id", False] == pytest.approx(300, rel=0.25) and n["no id", True] == pytest.approx(300, rel=0.25)
    assert n["one id", False] == pytest.approx(1800, rel=0.1)


def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (3, 5, "user", "a"), (3, 6, "bot", "b"), (4, 0, "user", "c"), (4, 0, "user", "c"), (5, None, None, None), (None, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["chat"]) for r in chat.format_conversations(df).collect()}
    assert got == {2: (2, "<|user|>\na\n<|bot|>\nb\n"), 4: (1, "<|user|>\nc\n"), 5: (1, "<||>\n\n")}
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_sketches_estimate_and_merge(spark):
    a, b = [f"w{k}" for k in range(3000)], [f"w{k}" for k in range(1000, 3000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:1500]), " ".join(a[1496:]))], "a string, b string, p string, q string")
    s = df.select(*(fingerprint.sketch(F.col(c)).alias(c) for c in "abpq"))
    row = s.select(
        fingerprint.resemblance(F.col("a"), F.col("b")).alias("r"),
        fingerprint.containment(F.col("b"), F.col("a")).alias("c"),
        fingerprint.distinct_shingles(F.col("a")).alias("n"),
        (fingerprint.merged(F.col("p"), F.col("q")) == F.col("a")).alias("same"),
    ).first()
    assert row["r"] == pytest.approx(2 / 3, abs=0.15) and row["c"] == 1.0 and row["n"] == pytest.approx(2996, rel=0.3) and row["same"]
    parts = s.select(F.lit(1).alias("k"), F.explode(F.array("p", "q")).alias("s"))
    assert fingerprint.merged_by(parts, ["k"], "s").first()["s"] == s.first()["a"]


def test_edits_take_the_next_text(spark, make):
    rows = [(1, "abcdef"), (3, "xy"), (7, None), (9, "one two three four five six"), (9, "0"), (None, "né ü")]
    out = fingerprint.fingerprint_edits(make(rows)).collect()
    order = ["né ü", "abcdef", "xy", "", "0", "one two three four five six"]
    want = sorted(t[: len(t) - len(t) // 2] + order[(k + 1) % 6][: len(t) // 2] for k, t in enumerate(order))
    assert sorted(r["edited"] for r in out) == want and all(0 <= r["near_next"] <= 1 for r in out)
    assert fingerprint.fingerprint_edits(make([])).count() == 0


def test_languages(spark, make):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(df)
    held = language.predict(df.filter(language.fold_of() == 2).drop("lang"), model).join(df.select("doc_id", "lang"), "doc_id")
    assert held.filter("lang_pred = lang").count() / held.count() > 0.98
    odd = language.predict(make([(1, None), (2, ""), (3, "123 !!"), (4, "the and of")]).drop("lang"), model)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in odd.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in model.languages
    assert language.predict(make([]).drop("lang"), model).count() == 0
    none = language.fit(make([]))
    assert {r["lang_pred"] for r in language.predict(make([(1, "abc")]).drop("lang"), none).collect()} == {"und"}
    assert re.fullmatch("[a-z]{2}", model.languages[0])
    assert language.codewords(4).shape == (4, 7) and len({tuple(r) for r in language.codewords(40)}) == 40


def test_rare_labels_are_learned(spark):
    rows = [(1 if k % 3 else k, f"the cat and the dog number {k} sat on the mat", "en") for k in range(4000)]
    rows += [(10_000 + k, "der Hund und die Katze liegen auf dem Teppich", "de") for k in range(3)] + [(20_000, "ћирилица је писмо", "sr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, most_rows=100, held_out=None)
    assert model.languages == ["de", "en", "sr"]
    got = {r["lang"]: r["lang_pred"] for r in language.predict(df.filter("doc_id >= 9999"), model).collect()}
    assert got == {"de": "de", "sr": "sr"}
    assert language.label_bound([4000, 3, 1], 100) == 96 and language.label_bound([5, 5], 100) == 100 and language.label_bound([], 9) == 9
    assert language.label_bound([50, 50, 50], 30) == 10 and language.label_bound([9] * 50, 30) == 1
