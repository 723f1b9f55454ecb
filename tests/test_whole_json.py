"""json_extract reads the texts of the conversations."""

from plumbline.plans import catalog


def test_texts_are_read(spark, tmp_path):
    rows = [(1, 0, "user", "plain words"), (1, 1, "user", "two\nlines and a number 7"), (2, 0, "user", "")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.conv_id, r.turn): r.k for r in catalog.json_extract(spark, str(tmp_path)).collect()}
    assert got == {(c, t): x for c, t, _, x in rows}


def test_all_feature_columns(spark, tmp_path):
    rows = [(1, "I heard of a promo, my iphone, 5 stars", "en", "a", 1), (2, "plain", "en", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.review_id: r for r in catalog.QUERIES["feature_stage_whole"](spark, str(tmp_path)).collect()}
    names = ("nonvisit_hits", "offtopic_hits", "promo_hits", "contact_hits", "star_rating_mention", "has_url", "token_len", "place_review_count")
    assert [got["1"][c] for c in names] == [1, 1, 1, 0, True, False, 9, 2]
    assert [got["2"][c] for c in names] == [0, 0, 0, 0, False, False, 1, 2]
