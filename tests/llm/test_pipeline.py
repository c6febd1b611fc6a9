"""The pipeline's stages, each judged on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from cumulus.llm import packing, pii
from tests.conftest import SF_SMALL
from tests.llm.test_lines_and_chat import brute as line_brute
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_search_langid_packing import packed, token_lengths


@pytest.fixture(scope="module")
def kept(spark):
    """The output of every stage, by name; the last is the packing."""
    from cumulus.llm.common import materialize, read_table
    docs, out = read_table(spark, SF_SMALL, "documents"), {}
    out["input"] = docs
    for name, stage in cp.STAGES:
        docs = out[name] = materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
    return out


def as_dict(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_order(kept):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "personal_data", "packing"]
    for name, _ in cp.STAGES[:-1]:
        assert kept[name].dtypes == kept["input"].dtypes, name


def test_clean_documents_pass_the_language_stage(kept):
    before, after = as_dict(kept["input"]), as_dict(kept["language_id"])
    letters = {i for i, r in before.items() if any(map(str.isalpha, r["text"] or ""))}
    assert set(after) == letters
    assert all(after[i]["text"] == before[i]["text"] for i in after)


def test_confident_predictions_become_the_language(kept, spark):
    from cumulus.llm import langid

    before, after = as_dict(kept["input"]), as_dict(kept["language_id"])
    model = langid.fit(kept["input"], F.lit(True))
    told = {r["doc_id"]: r for r in langid.predict(kept["input"], model).collect()}
    assert {i: r["lang"] for i, r in after.items()} == {
        i: told[i]["lang_pred"] if told[i]["score"] >= cp.CONFIDENT else before[i]["lang"] or told[i]["lang_pred"] for i in after}
    rows = [(10**6 + i, t, lang, "s", 0) for i, (t, lang) in enumerate(
        [(before[next(j for j in after if after[j]["lang"] == "en")]["text"], "de"), ("A.", "es"), ("A.", None)])]
    docs = kept["input"].unionByName(spark.createDataFrame(rows, kept["input"].schema))
    got = {r["doc_id"]: r["lang"] for r in cp.keep_known_language(spark, docs, SF_SMALL).where("doc_id >= 1000000").collect()}
    assert got[10**6] == "en" and got[10**6 + 1] == "es" and got[10**6 + 2] is not None


def test_lines(kept):
    before, after = as_dict(kept["language_id"]), as_dict(kept["line_dedup"])
    want = line_brute([(i, r["text"]) for i, r in before.items()])
    assert {i: r["text"] for i, r in after.items()} == {i: t for i, _, _, t in want}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_one_document_of_each_group_stays(kept):
    before, after = as_dict(kept["line_dedup"]), as_dict(kept["near_dedup"])
    want = near_brute([(i, r["text"]) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, _, stays) in want.items() if stays}


def test_personal_data_is_masked_and_the_rest_untouched(kept):
    before, after = as_dict(kept["near_dedup"]), as_dict(kept["personal_data"])
    assert set(before) == set(after)
    for i, r in before.items():
        spans = pii.find_spans(r["text"])
        assert after[i]["text"] == (pii.redact(r["text"], spans) if spans else r["text"])


def test_packing_holds_every_token(kept):
    assert packed(kept["packing"].collect()) == token_lengths({i: r["text"] for i, r in as_dict(kept["personal_data"]).items()})


def test_run_gives_the_rows_of_the_stages(spark, kept):
    total = lambda df: df.groupBy("doc_id").sum("length").collect()
    assert sorted(total(cp.run(spark, SF_SMALL))) == sorted(total(kept["packing"]))


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, kept int, spans int"
    odd = [(None, None, None, None, None, "x", 1, 2), (1, "", "en", "s", 0, "x", 1, 2), (2, "The house. a@b.co", "en", None, 5, None, 1, 2),
           (2, "The house. a@b.co", "en", None, 5, None, 1, 2), (None, "The other house", None, "s", None, "x", None, None)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in cp.STAGES:
            docs = stage(spark, docs, SF_SMALL)
            if name != "packing":
                assert docs.columns == cp.COLUMNS
        assert (docs.count() > 0) == bool(rows)


def test_packing_stage_cuts_texts_without_blanks(spark, make_docs):
    rows = {1: "一二三四五六七八九十" * 4000, 2: "a1b2" * 9000, 3: "two words", 4: " \t ", 5: None, 6: ""}
    got = cp.pack_sequences(spark, make_docs(list(rows.items())), SF_SMALL).collect()
    want = token_lengths(rows)
    assert packed(got) == want and want[1] > 8192 and want[2] > 8192
    assert all(r["length"] <= max(packing.CAPACITIES) for r in got)
    assert {r["doc_id"] for r in got if r["capacity"] is None} == {5, 6}


def test_account_numbers_are_masked_in_the_pipeline(spark, make_docs):
    docs = make_docs([(1, "pay IBAN DE89 3704 0044 0532 0130 00 or SSN 123-45-6789 now")])
    assert cp.mask_personal_data(spark, docs, SF_SMALL).first()["text"] == "pay IBAN <SECRET> or SSN <SECRET> now"
