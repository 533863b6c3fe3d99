from __future__ import annotations

from tokenizers import Tokenizer

import corpus_pipeline
from slowtide.llm import language, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, copy int, n_lines int, _row int"


def table(spark, rows):
    """Documents from (doc_id, text, lang, source), with further columns that stages use themselves."""
    return spark.createDataFrame([(*r, 0, 0.5, 7, 8, 9) for r in rows], SCHEMA)


def test_languages_replace_labels(spark):
    words = {"en": "the cat and the dog sat on the mat", "de": "der Hund und die Katze liegen auf dem Teppich"}
    rows = [(k, f"{words[lang]} {k}", lang, "s") for k, lang in enumerate(["en", "de"] * 20)]
    odd = [(100, None, "en", "s"), (101, "123", "de", "s"), (None, words["en"], None, "s"), (3, words["de"], "de", "s")]
    df = table(spark, rows + odd)
    out = corpus_pipeline.identify_language(spark, df, "")
    assert out.columns == df.columns
    want = [(i, t, "en" if "the" in t else "de") for i, t, _, _ in rows + odd if t and t != "123"]
    assert sorted(map(str, out.select("doc_id", "text", "lang").collect())) == sorted(f"Row(doc_id={i}, text={t!r}, lang={x!r})" for i, t, x in want)
    assert {r["score"] for r in out.collect()} == {0.5}
    assert corpus_pipeline.identify_language(spark, df.limit(0), "").count() == 0


def test_lines_go_and_length_follows(spark):
    rows = [(k, f"menu\nown {k}", "en", "h") for k in range(6)] + [(7, None, "en", "h"), (8, "menu", "en", None), (0, "menu\nown 0", "en", "h")]
    df = table(spark, rows)
    out = corpus_pipeline.drop_lines(spark, df, "")
    want = [(i, t if s is None or t is None else t.replace("menu\n", "")) for i, t, _, s in rows]
    got = [(r["doc_id"], r["text"], r["n_chars"], r["n_lines"]) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(str((i, t, None if t is None else len(t), 8)) for i, t in want) and out.columns == df.columns
    assert corpus_pipeline.drop_lines(spark, df.limit(0), "").count() == 0


def test_rows_of_a_large_source_spread(spark):
    """Later stages get tasks of even size, though boilerplate is joined by source."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df = table(spark, [(k if k % 2 else None, f"menu\nown {k}", "en", "h") for k in range(400)])
        sizes = [len(x) for x in corpus_pipeline.drop_lines(spark, df, "").rdd.glom().collect()]
        assert sum(sizes) == 400 and max(sizes) < 100
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(3, a), (5, a + " end"), (5, b), (None, a), (None, a + " more"), (None, c), (None, c + " end"), (None, c), (6, b + " end"), (9, d), (9, d), (9, d + " end"), (1, None), (2, ""), (2, "")]
    df = table(spark, [(i, t, "en", "s") for i, t in rows])
    out = corpus_pipeline.join_near_duplicates(spark, df, "")
    got = [(r["doc_id"], r["text"], r["_row"]) for r in out.collect()]
    heads = sorted(str((i, (t or "")[:1])) for i, t, _ in got)
    assert heads == sorted(map(str, [(3, "a"), (5, "b"), (None, "c"), (9, "d"), (1, ""), (2, "")]))
    assert (5, b, 9) in got and (3, a, 9) in got and out.columns == df.columns


def test_mix_keeps_columns_and_ids(spark):
    df = table(spark, [(k, "abcd", "en", "big") for k in range(300)] + [(None, None, "en", "none"), (1, "xy", "en", None)])
    out = corpus_pipeline.mix_sources(spark, df, "")
    plain = mixing.mix(df.select("doc_id", "text", "source"))
    assert out.columns == df.columns and {r["copy"] for r in out.collect()} == {7}
    assert [r["doc_id"] for r in out.collect()] == [r["doc_id"] for r in plain.collect()]
    mixed = mixing.mix(df)
    assert mixed.columns == [c if c != "copy" else "copy_input" for c in df.columns] + ["copy", "shuffle_key"]
    assert corpus_pipeline.mix_sources(spark, df.limit(0), "").count() == 0


def test_prediction_beside_columns_of_its_names(spark):
    df = table(spark, [(1, "abc", "en", "s")])
    out = language.predict(df, language.fit(df.limit(0)))
    assert "score_input" in out.columns and out.first()["score"] == 0.0 and out.first()["score_input"] == 0.5


def test_ids_equal_the_library(spark, word_bpe):
    rows = [(1, "one two three", "en", "s"), (None, None, "en", None), (2, "", None, "s"), (1, "one two three", "en", "s")]
    library = Tokenizer.from_file(word_bpe)
    out = corpus_pipeline.encode(spark, table(spark, rows), "").select("doc_id", "lang", "source", "n_tokens", "ids")
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t, _, _ in rows]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((i, lang, s, len(x), x)) for (i, _, lang, s), x in zip(rows, ids, strict=True))
