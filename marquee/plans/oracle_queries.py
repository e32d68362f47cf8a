"""DuckDB SQL for every SQL-expressible registered query (same column names)."""

from __future__ import annotations

from marquee.functions import patterns as P
from marquee.plans import fixtures as X
from marquee.plans import oracle_sql as O
from marquee.plans.oracle_sql import q
from marquee.sources import pages as PG

SQL: dict[str, str] = {}


def _html_text(e: str) -> str:
    t = O.rx_replace(e, PG.TAG, "")
    for ent, ch in PG.ENTITIES:
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    return t


PAGE_HEADS = (
    "page_heads AS (SELECT page_id AS row_id, url, "
    f"CASE WHEN regexp_matches(html, {q(PG.H1_ANY)}) "
    f"THEN {_html_text(f'regexp_extract(html, {q(PG.H1_ANY)}, 1)')} END AS headline FROM pages)"
)
PAGES_LABELLED = (
    PAGE_HEADS + ", pages_labelled AS (SELECT row_id, url, headline, "
    f"{O.source_from_url('url', X.PAGE_MARKER, X.CLASS_A, X.CLASS_B)} AS source FROM page_heads)"
)
DOCS = "docs AS (SELECT doc_id AS row_id, text FROM documents)"


def _pass1(h: str) -> str:
    return f"({O.marker_word_count(h)} > {P.MAX_MARKER_WORDS} OR {O.marker_char_count(h)} > {P.MAX_MARKER_CHARS})"


def _length_ok(h: str) -> str:
    return f"(length({h}) BETWEEN {P.MIN_CHARS} AND {P.MAX_CHARS} AND {O.word_count(h)} >= {P.MIN_WORDS})"


def _prepared(src: str = "pages_labelled") -> str:
    h = "headline"
    return (
        f"prepared AS (SELECT row_id, headline, {O.encode_label('source', X.CLASS_A)} AS label FROM {src} "
        f"WHERE {h} IS NOT NULL AND NOT {_pass1(h)} AND {O.marker_ratio(h)} <= {P.MAX_MARKER_RATIO} "
        f"AND {_length_ok(h)} AND NOT {O.artifact_any(h)} AND source IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY headline ORDER BY row_id) = 1)"
    )


PREPARED = PAGES_LABELLED + ", " + _prepared()

SQL["page_headlines"] = f"WITH {PAGES_LABELLED} SELECT row_id, url, headline, source FROM pages_labelled"
SQL["scan_headlines"] = SQL["page_headlines"]
SQL["roundtrip_csv"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
SQL["label_from_url"] = (f"SELECT page_id AS row_id, {O.source_from_url('url', X.PAGE_MARKER, X.CLASS_A, X.CLASS_B)} "
                         "AS source FROM pages")
SQL["label_from_url_ci"] = (f"SELECT page_id AS row_id, {O.source_from_url_ci('url', 'EXAMPLE.COM', X.CLASS_A, X.CLASS_B)} "
                            "AS source FROM pages")
SQL["label_encode"] = (
    f"WITH {PAGES_LABELLED}, e AS (SELECT row_id, {O.encode_label('source', X.CLASS_A)} AS label FROM pages_labelled) "
    f"SELECT row_id, label, CASE label WHEN 1 THEN {q(X.CLASS_A)} WHEN 0 THEN {q(X.CLASS_B)} END AS source_name FROM e"
)
SQL["norm_punct"] = f"WITH {DOCS} SELECT row_id, {O.normalize_punct('text')} AS text_out FROM docs"
SQL["norm_money"] = f"WITH {DOCS} SELECT row_id, {O.replace_money('text')} AS text_out FROM docs"
SQL["ascii_fold"] = f"WITH {DOCS} SELECT row_id, {O.ascii_fold('text')} AS text_out FROM docs"
SQL["clean_headline"] = f"WITH {DOCS} SELECT row_id, {O.clean_headline('text')} AS text_out FROM docs"
_TITLE = f"regexp_extract(html, {q('(?is)<title>(.*?)</title>')}, 1)"
SQL["strip_suffix"] = (
    f"WITH t AS (SELECT page_id AS row_id, {_TITLE} || CASE WHEN contains(url, {q(X.PAGE_MARKER)}) "
    f"THEN {q(P.TITLE_SUFFIXES[0])} ELSE {q(P.TITLE_SUFFIXES[3])} END AS title FROM pages) "
    f"SELECT row_id, {O.strip_title_suffix('title')} AS headline FROM t"
)
SQL["dedupe_key"] = f"WITH {DOCS} SELECT row_id, {O.dedupe_key('text')} AS key FROM docs"
SQL["length_stats_row"] = (f"WITH {DOCS} SELECT row_id, CAST(length(text) AS BIGINT) AS n_chars, "
                           f"{O.word_count('text')} AS n_words FROM docs")
SQL["tokens_ws"] = (
    f"WITH {DOCS}, t AS (SELECT row_id, {O.ws_tokens(O.clean_headline('text'))} AS toks FROM docs) "
    "SELECT row_id, CAST(pos - 1 AS BIGINT) AS pos, toks[pos] AS token FROM t, "
    "LATERAL (SELECT unnest(generate_series(1, len(toks))) AS pos) WHERE len(toks) > 0"
)
SQL["drop_null_headlines"] = f"WITH {PAGE_HEADS} SELECT row_id, url, headline FROM page_heads WHERE headline IS NOT NULL"
SQL["marker_word_count"] = f"WITH {DOCS} SELECT row_id, {O.marker_word_count('text')} AS n_marker_words FROM docs"
SQL["marker_char_count"] = f"WITH {DOCS} SELECT row_id, {O.marker_char_count('text')} AS n_marker_chars FROM docs"
SQL["marker_ratio"] = f"WITH {DOCS} SELECT row_id, round({O.marker_ratio('text')}, 6) AS marker_ratio FROM docs"
SQL["lang_filter_pass1"] = (f"WITH {PAGE_HEADS} SELECT row_id, headline FROM page_heads "
                            f"WHERE headline IS NOT NULL AND NOT {_pass1('headline')}")
SQL["lang_filter_pass2"] = (f"WITH {PAGE_HEADS} SELECT row_id, headline FROM page_heads "
                            f"WHERE headline IS NOT NULL AND NOT {_pass1('headline')} "
                            f"AND {O.marker_ratio('headline')} <= {P.MAX_MARKER_RATIO}")
SQL["length_filter"] = f"WITH {PAGE_HEADS} SELECT row_id, headline FROM page_heads WHERE {_length_ok('headline')}"
SQL["artifact_filter"] = (f"WITH {PAGE_HEADS} SELECT row_id, headline FROM page_heads "
                          f"WHERE headline IS NOT NULL AND NOT {O.artifact_any('headline')}")
_MW, _MC = O.marker_word_count("headline"), O.marker_char_count("headline")
SQL["borderline_rows"] = (
    f"WITH {PAGE_HEADS}, ph AS (SELECT * FROM page_heads WHERE headline IS NOT NULL) "
    f"SELECT row_id, 'pass1_counts' AS kind FROM ph WHERE ({_MW} = 3 AND {_MC} <= 1) OR ({_MC} = 3 AND {_MW} <= 1) "
    f"UNION ALL SELECT row_id, 'ratio' AS kind FROM ph WHERE NOT {_pass1('headline')} "
    f"AND {O.marker_ratio('headline')} > 0.14 AND {O.marker_ratio('headline')} < 0.18 "
    "UNION ALL SELECT row_id, 'short' AS kind FROM ph WHERE length(headline) > 15 AND length(headline) < 25"
)
_H = "headline"
SQL["filter_funnel"] = (
    f"WITH {PAGES_LABELLED}, s AS (SELECT {O.encode_label('source', X.CLASS_A)} AS y, CASE "
    f"WHEN {_H} IS NULL THEN 'null_headline' WHEN {_pass1(_H)} THEN 'language_pass1' "
    f"WHEN NOT ({O.marker_ratio(_H)} <= {P.MAX_MARKER_RATIO}) THEN 'language_pass2' "
    f"WHEN NOT {_length_ok(_H)} THEN 'length' WHEN {O.artifact_any(_H)} THEN 'artifact' ELSE 'kept' END AS stage "
    "FROM pages_labelled) SELECT stage, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(y) AS BIGINT) AS n_class1 "
    "FROM s GROUP BY stage"
)
SQL["prepare_headlines"] = f"WITH {PREPARED} SELECT row_id, headline, label FROM prepared"
SQL["style_features"] = f"WITH {PAGE_HEADS} SELECT row_id, {O.style_select('headline')} FROM page_heads"


# --- corpus -------------------------------------------------------------------

from marquee.functions import stopwords  # noqa: E402

DOC_TEXTS = (f"doc_texts AS (SELECT doc_id AS row_id, text AS headline, CASE WHEN lang = 'en' "
             f"THEN {q(X.CLASS_A)} ELSE {q(X.CLASS_B)} END AS source FROM documents)")
DOC_TRAIN = DOC_TEXTS + (", doc_train AS (SELECT row_id, headline, CAST(source = 'A' AS INT) AS label "
                         "FROM doc_texts)")
BASE_NEW = DOC_TEXTS + (
    ", base AS (SELECT row_id, CASE WHEN source = 'A' THEN 'https://www.FoxNews.com/a/' "
    "ELSE 'https://www.nbcnews.com/a/' END || CAST(row_id AS VARCHAR) AS url, headline FROM doc_texts "
    "WHERE row_id % 2 = 0), "
    "new AS (SELECT row_id, headline, source FROM doc_texts WHERE row_id % 2 = 1 UNION ALL "
    f"SELECT -1 - row_id, translate({O.rx_replace('headline', '[.,]', '')}, "
    f"{q(X.ASCII_LOWER)}, {q(X.ASCII_LOWER.upper())}) || '!', source FROM doc_texts WHERE row_id % 2 = 0)"
)


def _md5(col: str, seed: int = P.SEED) -> str:
    return f"md5(CAST({col} AS VARCHAR) || ':{seed}')"


EXACT = "exact AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY headline, source ORDER BY row_id) = 1)"
BALANCED = (EXACT + ", balanced AS (SELECT row_id, headline, source FROM exact QUALIFY row_number() OVER "
            f"(PARTITION BY source ORDER BY {_md5('row_id')}, row_id) <= "
            "(SELECT min(c) FROM (SELECT count(*) AS c FROM exact GROUP BY source)))")
MERGED = (
    BASE_NEW + ", " + BALANCED
    + f", labelled AS (SELECT row_id, headline, {O.source_from_url_ci('url', 'foxnews.com', X.CLASS_A, X.CLASS_B)} "
    "AS source FROM base WHERE headline IS NOT NULL), "
    f"normed AS (SELECT row_id, headline, source, {O.dedupe_key('headline')} AS k FROM balanced), "
    "fresh AS (SELECT * FROM normed WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_id) = 1), "
    f"merged AS (SELECT row_id, headline, source, 'base' AS origin FROM labelled UNION ALL "
    f"SELECT row_id, headline, source, 'new' AS origin FROM fresh f WHERE NOT EXISTS "
    f"(SELECT 1 FROM labelled l WHERE {O.dedupe_key('l.headline')} = f.k))"
)
SQL["dedupe_first"] = (f"WITH {DOC_TEXTS} SELECT row_id, headline, source FROM doc_texts "
                       "QUALIFY row_number() OVER (PARTITION BY headline ORDER BY row_id) = 1")
SQL["dedupe_exact"] = f"WITH {BASE_NEW}, {EXACT} SELECT row_id, headline, source FROM exact"
SQL["dedupe_normalized"] = (
    f"WITH {BASE_NEW}, k AS (SELECT *, {O.dedupe_key('headline')} AS k FROM new) "
    "SELECT row_id, headline, source FROM k WHERE k <> '' "
    "QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_id) = 1")
SQL["anti_join_base"] = (
    f"WITH {BASE_NEW} SELECT row_id, headline, source FROM new n WHERE NOT EXISTS "
    f"(SELECT 1 FROM base b WHERE {O.dedupe_key('b.headline')} = {O.dedupe_key('n.headline')})")
SQL["balance_classes"] = f"WITH {BASE_NEW}, {BALANCED} SELECT row_id, headline, source FROM balanced"
SQL["merge_corpus"] = f"WITH {MERGED} SELECT row_id, headline, source, origin FROM merged"
_MARKED = " ".join(f"WHEN {i} THEN {q(a)} || headline || {q(b)}" for i, (a, b) in enumerate(X.ARTIFACT_MARKS))
SQL["sample_per_check"] = (
    f"WITH {DOC_TEXTS}, marked AS (SELECT row_id, CASE row_id % {len(X.ARTIFACT_MARKS)} {_MARKED} END AS headline "
    "FROM doc_texts), hits AS (") + " UNION ALL ".join(
    f"SELECT row_id, headline, {q(name)} AS check_name FROM marked "
    f"WHERE {O.rx_has('headline', P.artifact_regex(body, True, 're2'))}" for name, body in P.ARTIFACT_CHECKS) + (
    ") SELECT row_id, headline, check_name FROM hits "
    f"QUALIFY row_number() OVER (PARTITION BY check_name ORDER BY {_md5('row_id')}, row_id) <= 3")
SQL["split_random"] = (
    f"SELECT doc_id AS row_id, (row_number() OVER (ORDER BY {_md5('doc_id')}, doc_id) - 1) "
    "< ceil(0.2 * count(*) OVER ()) AS is_test FROM documents")
SPLIT = DOC_TRAIN + (
    f", split AS (SELECT row_id, headline, label, (row_number() OVER (PARTITION BY label ORDER BY "
    f"{_md5('row_id')}, row_id) - 1) < ceil(count(*) OVER (PARTITION BY label) * 0.2) AS is_test FROM doc_train)")
SQL["split_stratified"] = f"WITH {SPLIT} SELECT row_id, label, is_test FROM split"


def _folds_sql(src: str, k: int = 5) -> str:
    cum, fold = None, []
    for i in range(k - 1):
        term = f"(floor((s + n - 1 - {i}) / {k}.0) - floor((s - 1 - {i}) / {k}.0))"
        cum = term if cum is None else f"{cum} + {term}"
        fold.append(f"CASE WHEN {cum} <= pos THEN 1 ELSE 0 END")
    return (f"cls AS (SELECT label, count(*) AS n FROM {src} GROUP BY label), "
            "cls2 AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND 1 PRECEDING), 0) AS s FROM cls), "
            f"posd AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) - 1 AS pos FROM {src}), "
            f"folded AS (SELECT posd.*, CAST({' + '.join(fold)} AS INT) AS fold FROM posd JOIN cls2 USING (label))")


SQL["stratified_folds"] = f"WITH {DOC_TRAIN}, {_folds_sql('doc_train')} SELECT row_id, label, fold FROM folded"
SQL["query_grid"] = (
    f"SELECT s.source, t.topic, CAST(d.d AS DATE) AS after, CAST(d.d + INTERVAL 1 DAY AS DATE) AS before "
    f"FROM (SELECT DISTINCT source FROM documents) s, (SELECT unnest({O.lst(P.GRID_TOPICS)}) AS topic) t, "
    f"(SELECT unnest(generate_series(DATE '{P.GRID_START}', DATE '{P.GRID_END}', INTERVAL 1 DAY)) AS d) d")
SQL["day_ranges"] = (
    "WITH u AS (SELECT user_id, CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events GROUP BY user_id) "
    "SELECT user_id, CAST(d AS DATE) AS after, CAST(d + INTERVAL 1 DAY AS DATE) AS before FROM u, "
    "LATERAL (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS d)")

# --- statistics -----------------------------------------------------------------

EDA = PAGES_LABELLED + (
    f", eda AS (SELECT row_id, headline, source, length(headline) AS len FROM pages_labelled "
    f"WHERE headline IS NOT NULL AND NOT {_pass1('headline')} AND {O.marker_ratio('headline')} < {P.MAX_MARKER_RATIO})")
STYLED = EDA + f", styled AS (SELECT row_id, source, {O.style_select('headline')} FROM eda)"
_FEATS = ", ".join(P.STYLE_FEATURES)
CELLS = STYLED + (
    f", longf AS (UNPIVOT (SELECT source, {_FEATS} FROM styled) ON {_FEATS} INTO NAME feature VALUE value), "
    "cells AS (SELECT feature, value, source, count(*) AS n FROM longf GROUP BY ALL)")
CHI = CELLS + (
    ", vals AS (SELECT DISTINCT feature, value FROM cells), "
    f"dense AS (SELECT v.feature, v.value, c.source, coalesce(x.n, 0) AS n FROM vals v, "
    f"(VALUES ({q(X.CLASS_A)}), ({q(X.CLASS_B)})) c(source) LEFT JOIN cells x "
    "ON x.feature = v.feature AND x.value = v.value AND x.source = c.source), "
    "m AS (SELECT *, sum(n) OVER (PARTITION BY feature, source) AS r, sum(n) OVER (PARTITION BY feature, value) AS c "
    "FROM dense), m2 AS (SELECT * FROM m WHERE r > 0 AND c > 0), "
    "m3 AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t FROM m2), "
    "dims AS (SELECT feature, count(DISTINCT value) AS n_cols, count(DISTINCT source) AS n_rows FROM m2 GROUP BY feature), "
    "terms AS (SELECT m3.feature, t, n_rows, n_cols, (n_rows - 1) * (n_cols - 1) AS dof, r * c / t AS e, n "
    "FROM m3 JOIN dims USING (feature)), "
    "chi AS (SELECT feature, sum(CASE WHEN dof = 1 THEN pow(greatest(abs(n - e) - 0.5, 0), 2) / e "
    "ELSE pow(abs(n - e), 2) / e END) AS chi2, CAST(any_value(dof) AS BIGINT) AS dof, "
    "CAST(any_value(t) AS BIGINT) AS n_obs, CAST(any_value(n_rows) AS BIGINT) AS n_rows, "
    "CAST(any_value(n_cols) AS BIGINT) AS n_cols FROM terms GROUP BY feature), "
    "cv AS (SELECT feature, sqrt(chi2 / nullif(n_obs * (least(n_rows, n_cols) - 1), 0)) AS cramers_v FROM chi)")
SQL["source_counts"] = f"WITH {MERGED} SELECT source, CAST(count(*) AS BIGINT) AS n FROM merged GROUP BY source"
SQL["length_describe"] = (
    f"WITH {EDA} SELECT source, CAST(count(len) AS BIGINT) AS count, round(avg(len), 6) AS mean, "
    "round(stddev_samp(len), 6) AS std, round(CAST(min(len) AS DOUBLE), 6) AS min, round(CAST(max(len) AS DOUBLE), 6) AS max, "
    "round(quantile_cont(len, 0.25), 6) AS p25, round(quantile_cont(len, 0.5), 6) AS p50, "
    "round(quantile_cont(len, 0.75), 6) AS p75 FROM eda GROUP BY source")
SQL["style_means"] = (f"WITH {STYLED} SELECT source, "
                      + ", ".join(f"round(avg({f}), 6) AS {f}" for f in P.STYLE_FEATURES)
                      + " FROM styled GROUP BY source")
SQL["style_crosstab"] = f"WITH {CELLS} SELECT feature, value, source, CAST(n AS BIGINT) AS n FROM cells"
SQL["chi2_style"] = f"WITH {CHI} SELECT feature, round(chi2, 6) AS chi2, dof, n_obs, n_rows, n_cols FROM chi"
SQL["cramers_v"] = f"WITH {CHI} SELECT feature, round(cramers_v, 6) AS cramers_v FROM cv"
SQL["style_significance"] = (
    f"WITH {CHI}, means AS (SELECT feature, avg(CASE WHEN source = {q(X.CLASS_A)} THEN value END) AS mean_a, "
    f"avg(CASE WHEN source = {q(X.CLASS_B)} THEN value END) AS mean_b FROM longf GROUP BY feature) "
    f"SELECT feature, CASE WHEN feature IN ({', '.join(q(f) for f in P.COUNT_STYLE_FEATURES)}) THEN 'count' "
    "ELSE 'binary' END AS kind, round(chi2, 6) AS chi2, dof, round(cramers_v, 6) AS cramers_v, "
    "round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b FROM chi JOIN cv USING (feature) JOIN means USING (feature)")
SQL["length_histogram"] = (
    f"WITH {EDA}, rng AS (SELECT source, CASE WHEN min(len) = max(len) THEN min(len) - 0.5 ELSE min(len) END::DOUBLE AS lo, "
    "CASE WHEN min(len) = max(len) THEN max(len) + 0.5 ELSE max(len) END::DOUBLE AS hi FROM eda GROUP BY source), "
    "b AS (SELECT source, lo, (hi - lo) / 30 AS w, CAST(least(floor((len - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin "
    "FROM eda JOIN rng USING (source)) "
    "SELECT source, bin, CAST(count(*) AS BIGINT) AS n, round(any_value(lo + bin * w), 6) AS \"left\", "
    "round(any_value(lo + (bin + 1) * w), 6) AS \"right\" FROM b GROUP BY source, bin")
SQL["length_boxplot"] = (
    f"WITH {EDA}, qs AS (SELECT source, quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.5) AS median, "
    "quantile_cont(len, 0.75) AS q3 FROM eda GROUP BY source) "
    "SELECT source, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
    "round(CAST(min(CASE WHEN len >= q1 - 1.5 * (q3 - q1) THEN len END) AS DOUBLE), 6) AS whisker_lo, "
    "round(CAST(max(CASE WHEN len <= q3 + 1.5 * (q3 - q1) THEN len END) AS DOUBLE), 6) AS whisker_hi, "
    "CAST(sum(CASE WHEN len < q1 - 1.5 * (q3 - q1) OR len > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) "
    "AS n_outliers FROM eda JOIN qs USING (source) GROUP BY source, q1, median, q3")
SQL["artifact_counts"] = f"WITH {EDA} " + " UNION ALL ".join(
    f"SELECT {q(name)} AS check_name, CAST(coalesce(sum(CAST(coalesce("
    f"{O.rx_has('headline', P.artifact_regex(body, True, 're2'))}, false) AS BIGINT)), 0) AS BIGINT) AS n_matches FROM eda"
    for name, body in P.ARTIFACT_CHECKS)
SQL["shortest_per_source"] = (
    f"WITH {EDA} SELECT source, row_number() OVER (PARTITION BY source ORDER BY len, row_id) AS rank, row_id, "
    "headline, CAST(len AS BIGINT) AS len FROM eda QUALIFY rank <= 3")
SQL["longest_per_source"] = (
    f"WITH {EDA} SELECT source, row_number() OVER (PARTITION BY source ORDER BY len DESC, row_id) AS rank, row_id, "
    "headline, CAST(len AS BIGINT) AS len FROM eda QUALIFY rank <= 3")
SQL["borderline_tail"] = (
    f"WITH {PAGE_HEADS}, ph AS (SELECT * FROM page_heads WHERE headline IS NOT NULL) "
    f"SELECT row_id, headline, {_MW} AS n_marker_words, {_MC} AS n_marker_chars FROM ph "
    f"WHERE ({_MW} = 3 AND {_MC} <= 1) OR ({_MC} = 3 AND {_MW} <= 1) ORDER BY row_id DESC LIMIT 5")

# --- tokens, vocabularies, tf-idf -----------------------------------------------

CLEAN_DOCS = DOCS + f", clean_docs AS (SELECT row_id, {O.clean_headline('text')} AS clean FROM docs)"


def _pos_tokens(src: str, arr: str) -> str:
    return (f"SELECT row_id, CAST(pos - 1 AS BIGINT) AS pos, toks[pos] AS token FROM "
            f"(SELECT row_id, {arr} AS toks FROM {src}) t, "
            "LATERAL (SELECT unnest(generate_series(1, len(toks))) AS pos) WHERE len(toks) > 0")


def _term_counts(src: str, arr: str) -> str:
    return (f"SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM "
            f"(SELECT row_id, unnest({arr}) AS term FROM {src}) GROUP BY row_id, term")


_STOP = O.lst(sorted(stopwords.english()))
SQL["token_counts"] = (f"WITH {CLEAN_DOCS}, toks AS ({_pos_tokens('clean_docs', O.ws_tokens('clean'))}) "
                       "SELECT token, CAST(count(*) AS BIGINT) AS n FROM toks GROUP BY token HAVING count(*) >= 2")
SQL["word_tokens"] = f"WITH {CLEAN_DOCS} {_pos_tokens('clean_docs', O.word_tokens('clean'))}"
SQL["word_tokens_default"] = f"WITH {DOCS} {_pos_tokens('docs', O.word_tokens('text', True))}"
SQL["stopword_tokens"] = (f"WITH {DOCS} " + _pos_tokens(
    "docs", f"list_filter({O.word_tokens('text', True)}, lambda w: NOT list_contains({_STOP}, w))"))
# tokens are cut once and pairs come from the next row: a list expression would cut them again for every pair
SQL["word_bigrams"] = (
    f"WITH {CLEAN_DOCS}, toks AS MATERIALIZED (SELECT row_id, {O.word_tokens('clean')} AS t FROM clean_docs), "
    "words AS MATERIALIZED (SELECT row_id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks), "
    "pairs AS (SELECT row_id, w || ' ' || lead(w) OVER (PARTITION BY row_id ORDER BY pos) AS term FROM words), "
    "grams AS (SELECT row_id, w AS term FROM words UNION ALL SELECT row_id, term FROM pairs WHERE term IS NOT NULL) "
    "SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM grams GROUP BY row_id, term")
SQL["char_ngrams"] = (f"WITH {PAGE_HEADS}, ph AS (SELECT row_id, {O.clean_headline('headline')} AS clean FROM page_heads) "
                      + _term_counts("ph", O.char_wb_ngrams("clean", 3, 5)))
TRAIN_VOCAB = SPLIT + (
    f", toks AS MATERIALIZED (SELECT row_id, is_test, {O.word_tokens(O.clean_headline('headline'))} AS t FROM split), "
    f"grams AS MATERIALIZED (SELECT row_id, is_test, {O.word_ngrams('t', 1, 2)} AS g FROM toks), "
    "tr AS (SELECT * FROM grams WHERE NOT is_test), "
    f"trc AS ({_term_counts('tr', 'g')}), "
    "vstats AS (SELECT term, count(*) AS df, sum(tf) AS total FROM trc GROUP BY term HAVING count(*) >= 2), "
    "vtop AS (SELECT * FROM vstats ORDER BY total DESC, term LIMIT 5000), "
    "vocab AS (SELECT term, CAST(df AS BIGINT) AS df, CAST(total AS BIGINT) AS total, "
    "CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS idx, "
    "ln((1 + (SELECT count(*) FROM tr)) / (1 + df)) + 1 AS idf FROM vtop)")
SQL["vocab_topn"] = (
    f"WITH {CLEAN_DOCS}, tc AS ({_term_counts('clean_docs', O.word_tokens('clean'))}) "
    "SELECT term, CAST(sum(tf) AS BIGINT) AS total, row_number() OVER (ORDER BY sum(tf) DESC, term) AS rank "
    f"FROM tc GROUP BY term ORDER BY total DESC, term LIMIT 100")
SQL["vocab_min_df"] = f"WITH {TRAIN_VOCAB} SELECT term, df, total, idx FROM vocab"
SQL["tf_sublinear"] = (f"WITH {CLEAN_DOCS}, tc AS ({_term_counts('clean_docs', O.word_tokens('clean'))}) "
                       "SELECT row_id, term, tf, round(1 + ln(tf), 6) AS tf_sublinear FROM tc")
SQL["idf"] = f"WITH {TRAIN_VOCAB} SELECT term, round(idf, 6) AS idf FROM vocab"
SQL["tfidf_long"] = (
    f"WITH {TRAIN_VOCAB}, alltc AS ({_term_counts('grams', 'g')}), "
    "w AS (SELECT row_id, a.term, (1 + ln(tf)) * idf AS w FROM alltc a JOIN vocab v ON a.term = v.term) "
    "SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM w")
TRAIN_TOKENS = SPLIT + (
    f", trtok AS ({_pos_tokens('(SELECT * FROM split WHERE NOT is_test)', O.ws_tokens(O.clean_headline('headline')))}), "
    "firsts AS (SELECT token, count(*) AS n, min(ROW(row_id, pos)) AS f FROM trtok GROUP BY token "
    "HAVING count(*) >= 2), "
    "vindex AS (SELECT token, CAST(row_number() OVER (ORDER BY f) + 1 AS INT) AS idx, CAST(n AS BIGINT) AS n FROM firsts)")
SQL["vocab_index"] = f"WITH {TRAIN_TOKENS} SELECT token, idx, n FROM vindex"
SQL["encode_tokens"] = (
    f"WITH {TRAIN_TOKENS}, alltok AS ({_pos_tokens('split', O.ws_tokens(O.clean_headline('headline')))}), "
    "coded AS (SELECT a.row_id, a.pos, coalesce(v.idx, 1) AS idx FROM alltok a LEFT JOIN vindex v ON a.token = v.token "
    f"WHERE a.pos < {P.SEQ_LEN}), "
    "lens AS (SELECT s.row_id, count(a.token) AS l FROM split s LEFT JOIN alltok a ON a.row_id = s.row_id GROUP BY s.row_id), "
    f"pads AS (SELECT row_id, CAST(unnest(generate_series(l, {P.SEQ_LEN - 1})) AS BIGINT) AS pos, 0 AS idx "
    f"FROM lens WHERE l < {P.SEQ_LEN}) "
    "SELECT row_id, pos, CAST(idx AS INT) AS idx FROM coded UNION ALL SELECT row_id, pos, CAST(idx AS INT) FROM pads")
STYLED_PAGES = PAGE_HEADS + f", sp AS (SELECT row_id, {O.style_select('headline')} FROM page_heads)"
SQL["maxabs_style"] = (f"WITH {STYLED_PAGES} SELECT row_id, " + ", ".join(
    f"round({f} / CASE WHEN (SELECT max(abs({f})) FROM sp) = 0 THEN 1.0 ELSE (SELECT max(abs({f})) FROM sp) END, 6) AS {f}"
    for f in P.STYLE_FEATURES) + " FROM sp")
SQL["standardize_style"] = (f"WITH {STYLED_PAGES} SELECT row_id, " + ", ".join(
    f"round(({f} - (SELECT avg({f}) FROM sp)) / CASE WHEN (SELECT stddev_pop({f}) FROM sp) = 0 THEN 1.0 "
    f"ELSE (SELECT stddev_pop({f}) FROM sp) END, 6) AS {f}" for f in P.STYLE_FEATURES) + " FROM sp")

# --- metrics over a fixed prediction rule -----------------------------------------

FIXED = ("fixed AS (SELECT doc_id AS row_id, quality AS label, ((doc_id * 37) % 101) / 100.0 AS score, "
         "CAST(((doc_id * 37) % 101) / 100.0 >= 0.5 AS INT) AS prediction FROM labels)")


def _per_class(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    parts = []
    for c in (0, 1):
        parts.append(
            f"SELECT {g}{c} AS class, sum(CASE WHEN label = {c} AND prediction = {c} THEN 1 ELSE 0 END) AS tp, "
            f"sum(CASE WHEN label <> {c} AND prediction = {c} THEN 1 ELSE 0 END) AS fp, "
            f"sum(CASE WHEN label = {c} AND prediction <> {c} THEN 1 ELSE 0 END) AS fn, "
            f"sum(CASE WHEN label = {c} THEN 1 ELSE 0 END) AS support FROM {src} {gb}")
    u = " UNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, "
            f"CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, "
            f"CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM ({u})")


SQL["accuracy"] = f"WITH {FIXED} SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM fixed"
SQL["macro_f1"] = f"WITH {FIXED}, pc AS ({_per_class('fixed')}) SELECT round(avg(f1), 6) AS macro_f1 FROM pc"
SQL["classification_report"] = (
    f"WITH {FIXED}, pc AS ({_per_class('fixed')}) "
    "SELECT CAST(class AS VARCHAR) AS row_name, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc "
    "UNION ALL SELECT 'accuracy', NULL, NULL, round(avg(CAST(label = prediction AS DOUBLE)), 6), count(*) FROM fixed "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), "
    "CAST(sum(support) AS BIGINT) FROM pc "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), "
    "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), "
    "CAST(sum(support) AS BIGINT) FROM pc")
RUNNING = FIXED + (
    ", per AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM fixed GROUP BY score), "
    "run AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, "
    "sum(neg) OVER (ORDER BY score DESC) AS cum_neg FROM per), "
    "tot AS (SELECT sum(label) AS p, sum(1 - label) AS nn FROM fixed)")
SQL["roc_points"] = (
    f"WITH {RUNNING} SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
    "SELECT round(CAST(score AS DOUBLE), 6), round(cum_neg / nn, 6), round(cum_pos / p, 6) FROM run, tot")
SQL["auc"] = f"WITH {RUNNING} SELECT round(sum((neg / nn) * (2 * cum_pos - pos) / (2 * p)), 6) AS auc FROM run, tot"
SQL["robust_accuracy"] = (
    f"WITH {FIXED}, x AS (SELECT CASE WHEN prediction = 1 THEN 'A' ELSE 'B' END AS p, label AS t FROM fixed), "
    "s AS (SELECT count(DISTINCT p) AS k, max(p) AS mx, count(*) AS n FROM x), "
    "a AS (SELECT sum(CASE WHEN t = CAST(p = mx AS INT) THEN 1 ELSE 0 END) AS a1, "
    "sum(CASE WHEN t = 1 - CAST(p = mx AS INT) THEN 1 ELSE 0 END) AS a2, "
    "sum(CASE WHEN CAST(t AS VARCHAR) = p THEN 1 ELSE 0 END) AS a3 FROM x, s) "
    "SELECT round(CASE WHEN n = 0 THEN 0.0 WHEN k = 2 THEN greatest(a1, a2) / n ELSE a3 / n END, 6) "
    "AS robust_accuracy FROM a, s")
SQL["cv_metrics"] = (
    f"WITH {FIXED}, {_folds_sql('fixed')}, pc AS ({_per_class('folded', 'fold')}), "
    "f1 AS (SELECT fold, avg(f1) AS f1 FROM pc GROUP BY fold), "
    "acc AS (SELECT fold, avg(CAST(label = prediction AS DOUBLE)) AS acc FROM folded GROUP BY fold) "
    "SELECT 'fixed_rule' AS pipeline, round(avg(f1), 4) AS f1_mean, round(stddev_pop(f1), 4) AS f1_std, "
    "round(avg(acc), 4) AS acc_mean, round(stddev_pop(acc), 4) AS acc_std FROM f1 JOIN acc USING (fold)")
_MODELS = " UNION ALL ".join(
    f"SELECT doc_id AS row_id, quality AS label, 'm{m}' AS model, ((doc_id * {m}) % 101) / 100.0 AS score FROM labels"
    for m in (37, 53, 71))
_THR = ", ".join(f"{t}::DOUBLE" for t in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9))
SQL["tuning_summary"] = (
    f"WITH ms AS ({_MODELS}), grid AS (SELECT row_id, label, model, threshold, "
    f"CAST(score >= threshold AS INT) AS prediction FROM ms, (SELECT unnest([{_THR}]) AS threshold)), "
    f"pc AS ({_per_class('grid', 'model, threshold')}), "
    "f AS (SELECT model, threshold, avg(f1) AS f1 FROM pc GROUP BY model, threshold), "
    "best AS (SELECT model, f1 AS best_f1, threshold AS best_threshold FROM f "
    "QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1), "
    "before AS (SELECT model, f1 AS before_f1 FROM f WHERE threshold = 0.5) "
    "SELECT model, round(before_f1, 6) AS before_f1, round(best_f1, 6) AS best_f1, "
    "round(best_f1 - before_f1, 6) AS delta, '{\"threshold\":\"' || CAST(best_threshold AS VARCHAR) || '\"}' "
    "AS best_params FROM best LEFT JOIN before USING (model)")
SQL["soft_vote"] = (
    "WITH s AS (SELECT doc_id AS row_id, (((doc_id * 37) % 101) / 100.0 + ((doc_id * 53) % 101) / 100.0 "
    "+ ((doc_id * 71) % 101) / 100.0) / 3 AS a FROM labels) "
    "SELECT row_id, round(a, 6) AS avg_score, CAST(a > 0.5 AS INT) AS prediction FROM s")
SQL["nb_counts"] = (
    f"WITH {DOC_TRAIN}, tc AS ({_term_counts('doc_train', O.word_tokens(O.clean_headline('headline')))}), "
    "per AS (SELECT label, term, sum(tf) AS n_ct FROM tc JOIN doc_train USING (row_id) GROUP BY label, term), "
    "terms AS (SELECT DISTINCT term FROM per), nc AS (SELECT label, sum(n_ct) AS n_c FROM per GROUP BY label), "
    "dense AS (SELECT t.term, l.label, coalesce(p.n_ct, 0) AS n_ct FROM terms t, (VALUES (0), (1)) l(label) "
    "LEFT JOIN per p ON p.term = t.term AND p.label = l.label) "
    "SELECT d.label, d.term, round(ln((n_ct + 1) / (coalesce(n_c, 0) + (SELECT count(*) FROM terms))), 6) AS log_prob "
    "FROM dense d LEFT JOIN nc USING (label)")

SQL["knn_classify"] = (
    "WITH tr AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings WHERE vec_id % 5 <> 0), "
    "te AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 5 = 0), "
    "d AS (SELECT te.vec_id AS q, tr.vec_id AS t, tr.label, list_distance(te.e, tr.e) AS dist FROM te, tr), "
    "top AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY q ORDER BY dist, t) <= 5), "
    "votes AS (SELECT q, label, count(*) AS n FROM top GROUP BY q, label) "
    "SELECT q AS vec_id, CAST(label AS INT) AS prediction FROM votes "
    "QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, label) = 1")

from marquee.sources.feeds import XML_INVALID  # noqa: E402

SQL["rss_titles"] = (
    f"WITH l AS (SELECT doc_id AS row_id, unnest(string_split({O.rx_replace(O.rx_replace('text', chr(13), ''), XML_INVALID, '')}, "
    f"chr(10))) AS line, lang FROM documents), "
    f"t AS (SELECT row_id, line || CASE WHEN lang = 'en' THEN {q(P.TITLE_SUFFIXES[0])} ELSE {q(P.TITLE_SUFFIXES[3])} END "
    "AS title FROM l WHERE line <> ''), "
    f"s AS (SELECT row_id, {O.strip_title_suffix('title')} AS headline FROM t) "
    "SELECT row_id, headline FROM s WHERE headline <> ''")
