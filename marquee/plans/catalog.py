"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the landed tables (or what Spark derives from them) in
full. Computed columns carry the same aliases as the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.functions.fold import ascii_fold
from marquee.functions.style import style_columns
from marquee.operators import filters as FL
from marquee.plans import fixtures as X
from marquee.plans.prepare import prepare_headlines
from marquee.session import checkpoint_dir, scratch_path
from marquee.sources.headlines import read_headlines, write_headlines

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__[2:]] = fn
    return fn


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return X.read(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "text")


def _pages_labelled(spark: SparkSession, sf: str) -> DataFrame:
    ph = X.page_heads(spark, sf)
    return ph.withColumn("source", T.source_from_url(F.col("url"), X.PAGE_MARKER, X.CLASS_A, X.CLASS_B))


def prepared_pages(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_headlines(X.page_heads(spark, sf), X.PAGE_MARKER, X.CLASS_A, X.CLASS_B)


# --- sources -----------------------------------------------------------------

@query
def q_page_headlines(spark, sf):
    return _pages_labelled(spark, sf)


@query
def q_scan_headlines(spark, sf):
    path = scratch_path(spark, "headlines-csv")
    write_headlines(_pages_labelled(spark, sf), path)
    return read_headlines(spark, path)


@query
def q_roundtrip_csv(spark, sf):
    path = scratch_path(spark, "documents-csv")
    docs = X.read(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_headlines(docs, path)
    return read_headlines(spark, path, schema="doc_id bigint, text string, lang string, source string, n_chars bigint")


# --- labels and projections ---------------------------------------------------

@query
def q_label_from_url(spark, sf):
    p = X.read(spark, sf, "pages").select("page_id", "url")
    return p.select(F.col("page_id").alias("row_id"),
                    T.source_from_url(F.col("url"), X.PAGE_MARKER, X.CLASS_A, X.CLASS_B).alias("source"))


@query
def q_label_from_url_ci(spark, sf):
    p = X.read(spark, sf, "pages").select("page_id", "url")
    return p.select(F.col("page_id").alias("row_id"),
                    T.source_from_url_ci(F.col("url"), "EXAMPLE.COM", X.CLASS_A, X.CLASS_B).alias("source"))


@query
def q_label_encode(spark, sf):
    x = _pages_labelled(spark, sf).select("row_id", T.encode_label(F.col("source"), X.CLASS_A).alias("label"))
    return x.select("row_id", "label", T.decode_label(F.col("label"), X.CLASS_A, X.CLASS_B).alias("source_name"))


@query
def q_norm_punct(spark, sf):
    return _docs(spark, sf).select("row_id", T.normalize_punct(F.col("text")).alias("text_out"))


@query
def q_norm_money(spark, sf):
    return _docs(spark, sf).select("row_id", T.replace_money(F.col("text")).alias("text_out"))


@query
def q_ascii_fold(spark, sf):
    return _docs(spark, sf).select("row_id", ascii_fold(F.col("text")).alias("text_out"))


@query
def q_clean_headline(spark, sf):
    return _docs(spark, sf).select("row_id", T.clean_headline(F.col("text")).alias("text_out"))


@query
def q_strip_suffix(spark, sf):
    pages = X.read(spark, sf, "pages").select("page_id", "url", "html")
    title = F.regexp_extract(F.col("html"), r"(?is)<title>(.*?)</title>", 1)
    suffix = F.when(F.col("url").contains(X.PAGE_MARKER), F.lit(P.TITLE_SUFFIXES[0])).otherwise(F.lit(P.TITLE_SUFFIXES[3]))
    titled = pages.select(F.col("page_id").alias("row_id"), F.concat(title, suffix).alias("title"))
    return titled.select("row_id", T.strip_title_suffix(F.col("title")).alias("headline"))


@query
def q_dedupe_key(spark, sf):
    return _docs(spark, sf).select("row_id", T.dedupe_key(F.col("text")).alias("key"))


@query
def q_length_stats_row(spark, sf):
    return _docs(spark, sf).select("row_id", F.length("text").cast("long").alias("n_chars"),
                                   T.word_count(F.col("text")).cast("long").alias("n_words"))


@query
def q_tokens_ws(spark, sf):
    toks = T.clean_tokens(T.clean_headline(F.col("text")))
    from marquee.operators.vocab import explode_positions
    return explode_positions(_docs(spark, sf), toks)


# --- filters ------------------------------------------------------------------

@query
def q_drop_null_headlines(spark, sf):
    return FL.drop_nulls(X.page_heads(spark, sf), ["headline"])


@query
def q_marker_word_count(spark, sf):
    return _docs(spark, sf).select("row_id", T.marker_word_count(F.col("text")).cast("long").alias("n_marker_words"))


@query
def q_marker_char_count(spark, sf):
    return _docs(spark, sf).select("row_id", T.marker_char_count(F.col("text")).cast("long").alias("n_marker_chars"))


@query
def q_marker_ratio(spark, sf):
    return _docs(spark, sf).select("row_id", F.round(T.marker_ratio(F.col("text")), 6).alias("marker_ratio"))


@query
def q_lang_filter_pass1(spark, sf):
    return FL.language_pass1(FL.drop_nulls(X.page_heads(spark, sf))).select("row_id", "headline")


@query
def q_lang_filter_pass2(spark, sf):
    x = FL.language_pass1(FL.drop_nulls(X.page_heads(spark, sf)))
    return FL.language_pass2(x).select("row_id", "headline")


@query
def q_length_filter(spark, sf):
    return FL.length_filter(X.page_heads(spark, sf)).select("row_id", "headline")


@query
def q_artifact_filter(spark, sf):
    return FL.artifact_filter(FL.drop_nulls(X.page_heads(spark, sf))).select("row_id", "headline")


@query
def q_borderline_rows(spark, sf):
    ph = FL.drop_nulls(X.page_heads(spark, sf))
    p1 = FL.borderline_pass1(ph).select("row_id", F.lit("pass1_counts").alias("kind"))
    p2 = FL.borderline_ratio(FL.language_pass1(ph)).select("row_id", F.lit("ratio").alias("kind"))
    p3 = FL.short_rows(ph).select("row_id", F.lit("short").alias("kind"))
    return p1.unionByName(p2).unionByName(p3)


@query
def q_filter_funnel(spark, sf):
    x = _pages_labelled(spark, sf).withColumn("label", T.encode_label(F.col("source"), X.CLASS_A))
    return FL.filter_funnel(x)


@query
def q_prepare_headlines(spark, sf):
    return prepared_pages(spark, sf)


# --- style --------------------------------------------------------------------

@query
def q_style_features(spark, sf):
    return X.page_heads(spark, sf).select("row_id", *style_columns("headline"))


# --- corpus: dedupe, anti join, balance, splits, folds, grid -----------------

from marquee.operators import corpus as C  # noqa: E402
from marquee.operators import metrics as M  # noqa: E402
from marquee.operators import stats as S  # noqa: E402
from marquee.operators import vocab as V  # noqa: E402
from marquee.functions import stopwords  # noqa: E402

SCORE_MULTIPLIERS = [37, 53, 71]
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
TOP_TERMS = 100
CHECK_SAMPLES = 3   # matched texts shown per artifact check


def _merged(spark, sf):
    return C.merge_corpus(X.base_corpus(spark, sf), X.new_corpus(spark, sf), P.SEED,
                          "foxnews.com", X.CLASS_A, X.CLASS_B)


@query
def q_dedupe_first(spark, sf):
    return C.dedupe_first(X.doc_texts(spark, sf))


@query
def q_dedupe_exact(spark, sf):
    return C.dedupe_exact(X.new_corpus(spark, sf))


@query
def q_dedupe_normalized(spark, sf):
    return C.dedupe_normalized(X.new_corpus(spark, sf))


@query
def q_anti_join_base(spark, sf):
    return C.anti_join_base(X.new_corpus(spark, sf), X.base_corpus(spark, sf))


@query
def q_balance_classes(spark, sf):
    return C.balance_classes(C.dedupe_exact(X.new_corpus(spark, sf)), "source", P.SEED)


@query
def q_merge_corpus(spark, sf):
    return _merged(spark, sf)


@query
def q_sample_per_check(spark, sf):
    hits = S.matched_checks(X.marked_texts(spark, sf), "headline")
    return C.sample_per_group(hits, ["check_name"], CHECK_SAMPLES, P.SEED)


@query
def q_split_random(spark, sf):
    return C.split_random(X.doc_texts(spark, sf).select("row_id")).select("row_id", "is_test")


@query
def q_split_stratified(spark, sf):
    return C.split_stratified(X.doc_train(spark, sf).select("row_id", "label"))


@query
def q_stratified_folds(spark, sf):
    return C.stratified_folds(X.doc_train(spark, sf).select("row_id", "label"))


@query
def q_query_grid(spark, sf):
    sources = X.read(spark, sf, "documents").select("source").distinct()
    return C.query_grid(sources)


@query
def q_day_ranges(spark, sf):
    ev = X.read(spark, sf, "events").groupBy("user_id").agg(
        F.to_date(F.min("ts")).alias("start"), F.to_date(F.max("ts")).alias("end"))
    return C.day_ranges(ev, "start", "end")


# --- statistics ----------------------------------------------------------------

def _eda_pages(spark, sf):
    """Exploratory set: page headlines after language pass 1 and ratio < 0.16."""
    x = _pages_labelled(spark, sf).where(F.col("headline").isNotNull())
    x = FL.language_pass2(FL.language_pass1(x), inclusive=False)
    return x.withColumn("len", F.length("headline"))


def _eda_styled(spark, sf):
    return _eda_pages(spark, sf).select("row_id", "source", *style_columns("headline"))


def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query
def q_source_counts(spark, sf):
    return S.value_counts(_merged(spark, sf), "source")


@query
def q_length_describe(spark, sf):
    return _r6(S.describe(_eda_pages(spark, sf), "source", "len"))


@query
def q_style_means(spark, sf):
    st = _eda_styled(spark, sf)
    return _r6(st.groupBy("source").agg(*[F.avg(f).alias(f) for f in P.STYLE_FEATURES]))


@query
def q_style_crosstab(spark, sf):
    return S.crosstab_long(_eda_styled(spark, sf), "source", P.STYLE_FEATURES)


def _chi(spark, sf):
    cells = S.crosstab_long(_eda_styled(spark, sf), "source", P.STYLE_FEATURES)
    return S.chi_square(cells, "source", F.array(F.lit(X.CLASS_A), F.lit(X.CLASS_B)))


@query
def q_chi2_style(spark, sf):
    return _r6(_chi(spark, sf))


@query
def q_cramers_v(spark, sf):
    return _r6(S.cramers_v(_chi(spark, sf)))


@query
def q_style_significance(spark, sf):
    sig = S.style_significance(_eda_styled(spark, sf), "source", X.CLASS_A, X.CLASS_B)
    return _r6(sig.drop("p_value"))


@query
def q_chi2_pvalue(spark, sf):
    sig = S.style_significance(_eda_styled(spark, sf), "source", X.CLASS_A, X.CLASS_B)
    return sig.select("feature", "kind", "chi2", "dof", "p_value")


@query
def q_length_histogram(spark, sf):
    return _r6(S.histogram(_eda_pages(spark, sf), "source", "len", 30))


@query
def q_length_boxplot(spark, sf):
    return _r6(S.boxplot_stats(_eda_pages(spark, sf), "source", "len"))


@query
def q_artifact_counts(spark, sf):
    return S.pattern_counts(_eda_pages(spark, sf), "headline")


@query
def q_shortest_per_source(spark, sf):
    x = S.top_k_per_group(_eda_pages(spark, sf), "source", [F.col("len"), F.col("row_id")], 3)
    return x.select("source", F.col("rank").cast("long").alias("rank"), "row_id", "headline",
                    F.col("len").cast("long").alias("len"))


@query
def q_longest_per_source(spark, sf):
    x = S.top_k_per_group(_eda_pages(spark, sf), "source", [F.col("len").desc(), F.col("row_id")], 3)
    return x.select("source", F.col("rank").cast("long").alias("rank"), "row_id", "headline",
                    F.col("len").cast("long").alias("len"))


@query
def q_borderline_tail(spark, sf):
    ph = FL.drop_nulls(X.page_heads(spark, sf))
    x = FL.borderline_pass1(ph).orderBy(F.col("row_id").desc()).limit(5)
    return x.select("row_id", "headline", T.marker_word_count(F.col("headline")).cast("long").alias("n_marker_words"),
                    T.marker_char_count(F.col("headline")).cast("long").alias("n_marker_chars"))


# --- tokens, vocabularies, tf-idf ----------------------------------------------

def _clean_docs(spark, sf):
    return _docs(spark, sf).select("row_id", T.clean_headline(F.col("text")).alias("clean"))


def _by_row(docs: DataFrame, sf: str, table: str = "documents") -> DataFrame:
    """Texts clustered by row before their terms are made: (row, term) counts need no further shuffle.

    The number of partitions follows the bytes of ``table``: a task counts the terms of a
    bounded share of the texts, whatever their number (AQE would join partitions by the
    bytes of the texts, and their terms are many times larger)."""
    return docs.repartition(X.shares(docs.sparkSession, sf, table), "row_id")


def _pos_tokens(df, arr):
    return V.explode_positions(df, arr)


@query
def q_token_counts(spark, sf):
    toks = V.explode_terms(_clean_docs(spark, sf), T.clean_tokens(F.col("clean")))
    return V.token_frequency(toks.withColumnRenamed("term", "token"))


@query
def q_word_tokens(spark, sf):
    return _pos_tokens(_clean_docs(spark, sf), T.word_tokens(F.col("clean")))


@query
def q_word_tokens_default(spark, sf):
    return _pos_tokens(_docs(spark, sf), T.word_tokens(F.col("text"), default_pattern=True))


@query
def q_stopword_tokens(spark, sf):
    toks = T.remove_stopwords(T.word_tokens(F.col("text"), default_pattern=True), stopwords.english())
    return _pos_tokens(_docs(spark, sf), toks)


@query
def q_word_bigrams(spark, sf):
    grams = T.with_ngrams(_by_row(_clean_docs(spark, sf), sf), T.word_tokens(F.col("clean")), 1, 2)
    return V.term_counts(grams, F.col("terms"))


@query
def q_char_ngrams(spark, sf):
    ph = X.page_heads(spark, sf).select("row_id", T.clean_headline(F.col("headline")).alias("clean"))
    return V.term_counts(_by_row(ph, sf, "pages"), T.char_wb_ngrams(F.col("clean"), 3, 5))


def _train_split(spark, sf):
    return C.split_stratified(_by_row(X.doc_train(spark, sf), sf))


def _bigrams(df):
    return T.with_ngrams(df, T.word_tokens(T.clean_headline(F.col("headline"))), 1, 2, keep=("row_id", "is_test"))


def _all_counts(spark, sf, vocab=None):
    """(row_id, is_test, term, tf) for every row, counted where the row's text is:
    the vocabulary is fitted on the training part, weights cover all rows. Of the terms of ``vocab`` only, if given."""
    grams = _bigrams(_train_split(spark, sf))
    terms = grams.select("row_id", "is_test", F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())
    if vocab is not None:
        terms = terms.join(F.broadcast(vocab.select("term")), "term", "left_semi")
    return terms.groupBy("row_id", "is_test", "term").agg(F.count(F.lit(1)).alias("tf"))


def _train_vocab(spark, sf):
    tc = _all_counts(spark, sf).where(~F.col("is_test"))
    n_docs = _train_split(spark, sf).where(~F.col("is_test")).agg(F.count(F.lit(1))).scalar()
    return V.idf(V.vocabulary(tc, max_features=5000, min_df=2), n_docs)


@query
def q_vocab_topn(spark, sf):
    terms = V.explode_terms(_clean_docs(spark, sf), T.word_tokens(F.col("clean")))
    top = terms.groupBy("term").agg(F.count(F.lit(1)).alias("total")).orderBy(F.col("total").desc(), "term").limit(TOP_TERMS)
    from pyspark.sql import Window as W
    return top.select("term", "total", F.row_number().over(W.orderBy(F.col("total").desc(), "term"))
                      .cast("long").alias("rank"))


@query
def q_vocab_min_df(spark, sf):
    return _train_vocab(spark, sf).select("term", "df", "total", "idx")


@query
def q_tf_sublinear(spark, sf):
    tc = V.term_counts(_by_row(_clean_docs(spark, sf), sf), T.word_tokens(F.col("clean")))
    return _r6(tc.withColumn("tf_sublinear", 1 + F.log(F.col("tf"))))


@query
def q_idf(spark, sf):
    return _r6(_train_vocab(spark, sf).select("term", "idf"))


@query
def q_tfidf_long(spark, sf):
    checkpoint_dir(spark)
    # at most max_features rows: written and broadcast, so that counts stay clustered by row up to the norm. Texts are cut
    # again for the weights: the counts of all terms would take many times the room of the texts
    vocab = _train_vocab(spark, sf).checkpoint()
    tc = _all_counts(spark, sf, vocab).select("row_id", "term", "tf")
    return _r6(V.tfidf(tc, F.broadcast(vocab), sublinear=True).select("row_id", "term", "weight"))


def _clean_tokens():
    return T.clean_tokens(F.col("clean"))


def _train_index(spark, sf):
    """Index of the training part's tokens; only the vocabulary is checkpointed."""
    checkpoint_dir(spark)
    train = C.split_stratified(X.doc_train(spark, sf)).where("is_test = false")
    train = train.select("row_id", T.clean_headline(F.col("headline")).alias("clean"))
    return V.vocab_index(V.explode_positions(train, _clean_tokens()))


@query
def q_vocab_index(spark, sf):
    return _train_index(spark, sf)


@query
def q_encode_tokens(spark, sf):
    docs = X.doc_train(spark, sf).select("row_id", T.clean_headline(F.col("headline")).alias("clean"))
    return V.encode(docs, _clean_tokens(), _train_index(spark, sf))


def _styled_pages(spark, sf):
    return X.page_heads(spark, sf).select("row_id", *style_columns("headline"))


@query
def q_maxabs_style(spark, sf):
    st = _styled_pages(spark, sf)
    scales = st.agg(F.struct(*[F.max(F.abs(f)).alias(f) for f in P.STYLE_FEATURES])).scalar()
    return _r6(st.select("row_id", *[
        (F.col(f) / F.when(scales[f] == 0, F.lit(1.0)).otherwise(scales[f])).alias(f) for f in P.STYLE_FEATURES]))


@query
def q_standardize_style(spark, sf):
    st = _styled_pages(spark, sf)
    # one aggregate row with the mean and deviation of every feature
    fit = st.agg(F.struct(*[F.struct(F.avg(f).alias("mu"), F.stddev_pop(f).alias("sd")).alias(f)
                            for f in P.STYLE_FEATURES])).scalar()
    cols = []
    for f in P.STYLE_FEATURES:
        mu, sd = fit[f]["mu"], fit[f]["sd"]
        cols.append(((F.col(f) - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(f))
    return _r6(st.select("row_id", *cols))


# --- metrics over a fixed prediction rule --------------------------------------

def _fixed(spark, sf):
    return X.fixed_predictions(spark, sf)


@query
def q_accuracy(spark, sf):
    return _r6(M.accuracy(_fixed(spark, sf)))


@query
def q_macro_f1(spark, sf):
    return _r6(M.macro_f1(_fixed(spark, sf)))


@query
def q_classification_report(spark, sf):
    return _r6(M.classification_report(_fixed(spark, sf), names={0: "0", 1: "1"}))


@query
def q_roc_points(spark, sf):
    return _r6(M.roc_points(_fixed(spark, sf)))


@query
def q_auc(spark, sf):
    return _r6(M.auc(_fixed(spark, sf)))


@query
def q_robust_accuracy(spark, sf):
    x = _fixed(spark, sf).select(F.when(F.col("prediction") == 1, F.lit("A")).otherwise(F.lit("B")).alias("prediction"),
                                 "label")
    return _r6(M.robust_accuracy(x, "prediction", "label"))


@query
def q_cv_metrics(spark, sf):
    folds = C.stratified_folds(_fixed(spark, sf))
    return M.fold_summary(folds, "fixed_rule")


def _multi_scores(spark, sf):
    lab = X.read(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), F.col("quality").alias("label"))
    return lab.select("row_id", "label", *[
        ((F.col("row_id") * m) % 101 / F.lit(100.0)).alias(f"m{m}") for m in SCORE_MULTIPLIERS])


@query
def q_tuning_summary(spark, sf):
    sc = _multi_scores(spark, sf)
    models = F.explode(F.array(*[F.struct(F.lit(f"m{m}").alias("model"), F.col(f"m{m}").alias("score"))
                                 for m in SCORE_MULTIPLIERS])).alias("ms")
    long = sc.select("row_id", "label", models).select("row_id", "label", "ms.model", "ms.score")
    grid = long.select("*", F.explode(F.array(*[F.lit(t) for t in THRESHOLDS])).alias("threshold"))
    grid = grid.withColumn("prediction", (F.col("score") >= F.col("threshold")).cast("int"))
    f1 = M.macro_f1(grid, group_cols=["model", "threshold"])
    best = f1.groupBy("model").agg(F.max(F.struct(F.col("macro_f1"), (-F.col("threshold")).alias("nt"))).alias("b"))
    best = best.select("model", F.col("b.macro_f1").alias("best_f1"), (-F.col("b.nt")).alias("best_threshold"))
    before = f1.where(F.col("threshold") == 0.5).select("model", F.col("macro_f1").alias("before_f1"))
    out = best.join(before, "model", "left")
    params = F.to_json(F.create_map(F.lit("threshold"), F.col("best_threshold").cast("string")))
    return _r6(out.select("model", "before_f1", "best_f1", (F.col("best_f1") - F.col("before_f1")).alias("delta"),
                          params.alias("best_params")))


@query
def q_soft_vote(spark, sf):
    sc = _multi_scores(spark, sf)
    avg = sum(F.col(f"m{m}") for m in SCORE_MULTIPLIERS) / len(SCORE_MULTIPLIERS)
    return _r6(sc.select("row_id", avg.alias("avg_score"), (avg > 0.5).cast("int").alias("prediction")))


@query
def q_nb_counts(spark, sf):
    tr = X.doc_train(spark, sf)
    # the label rides along as the key of the exploded terms
    terms_of = V.explode_terms(tr, T.word_tokens(T.clean_headline(F.col("headline"))), "label")
    per = terms_of.groupBy(F.col("row_id").alias("label"), "term").agg(F.count(F.lit(1)).alias("n_ct"))
    terms = per.select("term").distinct()
    n_terms = terms.agg(F.count(F.lit(1))).scalar()
    dense = (terms.select("term", F.explode(F.array(F.lit(0), F.lit(1))).alias("label"))
             .join(per, ["label", "term"], "left").withColumn("n_ct", F.coalesce(F.col("n_ct"), F.lit(0))))
    n_c = per.groupBy("label").agg(F.sum("n_ct").alias("n_c"))
    out = dense.join(n_c, "label", "left").select(
        "label", "term", F.log((F.col("n_ct") + 1) / (F.coalesce(F.col("n_c"), F.lit(0)) + n_terms)).alias("log_prob"))
    return _r6(out)


@query
def q_rss_titles(spark, sf):
    from marquee.sources.feeds import feed_from_lines, feed_titles
    d = X.read(spark, sf, "documents").select("doc_id", "text", "lang")
    suffix = F.when(F.col("lang") == "en", F.lit(P.TITLE_SUFFIXES[0])).otherwise(F.lit(P.TITLE_SUFFIXES[3]))
    feeds = d.select(F.col("doc_id").alias("row_id"), feed_from_lines(F.col("text"), suffix).alias("feed"))
    return feed_titles(feeds)
