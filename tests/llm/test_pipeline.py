import corpus_pipeline as C
from pyspark.sql import functions as F

from lexicord.llm import decontam, linededup, ngramjoin, queries
from lexicord.llm.shared import written


def test_stages_keep_what_they_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in C.STAGES:
        after = written(stage(spark, before, sf_dir))
        if name != "tokens":
            assert after.columns == docs.columns
        assert after.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        if name == "quality":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            assert after.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * before.join(labels.where("quality = 1"), "doc_id").count()
        if name == "lines":
            again = linededup.line_dedup(after).agg(F.sum("n_exact")).first()[0]
            assert again == 0 and after.where("n_chars != length(text)").count() == 0
        if name == "near_duplicates":
            groups = ngramjoin.document_components(before, 5, 80)
            assert after.count() == groups.select("component_id").distinct().count()
        if name == "decontamination":
            gone = {r.doc_id for r in decontam.contaminated(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == gone
        before = after
    assert before.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert before.count() > 0


def test_run(spark, sf_dir):
    assert C.run(spark, sf_dir).count() > 100


def test_line_stage_drops_copies_with_short_and_blank_lines(spark):
    long = "the first line of a text that is long enough to count\nanother one follows it and has no word edit in common"
    rows = [(1, f"Title\n\n{long}\n "), (2, f"Title\n\n{long}\n "), (3, f"\n{long}\n\n"), (4, f"Title\n{long}\nOwn"), (5, " \n"), (6, ""), (7, None), (8, "Own")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in C.line_stage(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 4: "Own", 5: " \n", 6: "", 7: None}


def test_line_query_compares_lines_of_any_length(spark, tmp_path):
    spark.createDataFrame([(1, "x\n\na b"), (2, "x\n\na b\ny")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_exact for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 2}


def test_stages_take_odd_rows(spark, sf_dir):
    """Null ids, texts and columns, empty and repeated rows, one id twice, a very long text, and columns whose names stages use themselves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = docs.limit(60).collect()
    long_text = "\n".join(f"line {k} of a text that goes on for very long with word{k * 7} and word{k * 11}" for k in range(6000))
    rows = [tuple(r) for r in own] + [tuple(own[0])] * 2 + [(own[1].doc_id, "another text of the same id, short.", "en", "s", 3)]
    rows += [(None, own[2].text, None, None, None), (None, None, "en", "s", 0), (None, None, "en", "s", 0), (9001, "", "en", "s", 0), (9002, " \n\t", None, "s", 3), (9003, long_text, "en", "s", len(long_text))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    more = "id long, key string, tie long, words string, label int, `group` int, n long, tokens string, component_id long"
    clash = spark.createDataFrame([(*r, 1, "k", 2, "w", 0, 5, 6, "t", 7) for r in rows], f"{schema}, {more}").repartition(3)
    for name, stage in C.STAGES:
        after = written(stage(spark, clash, sf_dir))
        got = after.collect()
        assert len(got) <= len(rows) and not {r.doc_id for r in got} - {r[0] for r in rows}
        if name == "tokens":
            assert len(got) == len(rows)
            continue
        assert after.columns == clash.columns and after.schema["n_chars"].dataType == clash.schema["n_chars"].dataType
        texts = {r[0]: r[1] for r in rows}
        if name != "quality":  # clean rows stay
            kept = 2 if name == "lines" else 3  # a row without id comes last, and its lines are those of an earlier one
            assert {9001, 9002} <= {r.doc_id for r in got} and sum(r.doc_id is None for r in got) == kept
        if name not in ("quality", "lines"):
            assert 9003 in {r.doc_id for r in got} and all(r.text == texts[r.doc_id] for r in got if r.doc_id not in (None, own[1].doc_id))
        assert stage(spark, clash.limit(0), sf_dir).count() == 0
    assert C.token_stage(spark, clash.limit(0), sf_dir).count() == 0
