from pyspark.sql import functions as F

from rankfold.functions.text import STOP_WORDS, interior_terms, query_slug, tokenize


def _tok(spark, s, fn=tokenize):
    return spark.createDataFrame([(s,)], "t string").select(fn("t").alias("x")).first()["x"]


def test_stop_words_and_min_length(spark):
    assert _tok(spark, "The wing AND a flow, x of Ab") == ["wing", "flow", "ab"]


def test_unicode_letters_and_digits(spark):
    assert _tok(spark, "Élan vital_2 über-Straße 42") == ["élan", "vital_2", "über", "straße", "42"]


def test_stop_word_inside_longer_run_is_kept(spark):
    # 'the' is a stop word, 'their' too, but 'theme' and 'anthem' are not
    assert _tok(spark, "the theme of their anthem") == ["theme", "anthem"]


def test_null_text_gives_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(tokenize("t").alias("x")).first()["x"] == []


def test_stop_list_is_33_words():
    assert len(STOP_WORDS) == 33 and len(set(STOP_WORDS)) == 33


def test_interior_terms_skip_partial_edges(spark):
    # 'low' may be the tail of 'flow' in a document, 'wav' the head of 'wave'
    assert _tok(spark, "low heat shock wav", interior_terms) == ["heat", "shock"]
    assert _tok(spark, " heat shock ", interior_terms) == ["heat", "shock"]


def test_slug(spark):
    df = spark.createDataFrame([("what is it. ok",)], "q string")
    assert df.select(query_slug("q").alias("s")).first()["s"] == "what_is_it_ok"


def test_tokenizer_matches_filter_form(spark):
    from rankfold.functions.text import TOKEN_PATTERN

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    ref = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN_PATTERN), 0),
                   lambda t: ~F.array_contains(stops, t))
    bad = df.where(tokenize("text") != ref).count()
    assert bad == 0
