"""DuckDB statements of the same semantics, used as the correctness oracle.

Each helper takes a SQL expression and returns a DuckDB SQL expression that
computes what the Spark function of the same name computes. Regexes are the
shared-dialect constants from ``patterns``; only the call syntax differs.
"""

from __future__ import annotations

from marquee.functions import patterns as P
from marquee.functions.fold import fold_tables


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_replace(e: str, pat: str, rep: str) -> str:
    return f"regexp_replace({e}, {q(pat)}, {q(rep)}, 'g')"


def rx_count(e: str, pat: str) -> str:
    return f"len(regexp_extract_all({e}, {q(pat)}))"


def rx_has(e: str, pat: str) -> str:
    return f"regexp_matches({e}, {q(pat)})"


def lst(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


# --- labels -----------------------------------------------------------------

def source_from_url(e, marker=P.OUTLET_A_SITE, a=P.OUTLET_A, b=P.OUTLET_B):
    return f"CASE WHEN coalesce(contains({e}, {q(marker)}), false) THEN {q(a)} ELSE {q(b)} END"


def source_from_url_ci(e, marker=P.OUTLET_A_SITE, a=P.OUTLET_A, b=P.OUTLET_B):
    return (f"CASE WHEN coalesce({rx_has(e, P.case_insensitive(marker, 're2'))}, false) "
            f"THEN {q(a)} ELSE {q(b)} END")


def encode_label(e, a=P.OUTLET_A):
    return f"CASE WHEN {e} = {q(a)} THEN 1 ELSE 0 END"


# --- normalisation ----------------------------------------------------------

def ascii_fold(e: str) -> str:
    src, dst, multi = fold_tables()
    t = e
    for ch, rep in sorted(multi.items()):
        t = f"replace({t}, {q(ch)}, {q(rep)})"
    t = f"translate({t}, {q(src)}, {q(dst)})"
    return rx_replace(t, r"[^\x{00}-\x{7f}]", "")


def normalize_punct(e):
    return f"translate({e}, {q(P.PUNCT_FROM)}, {q(P.PUNCT_TO)})"


def replace_money(e):
    return rx_replace(e, P.money_regex("re2"), P.MONEY_TOKEN)


def collapse_ws(e):
    return f"trim({rx_replace(e, f'[{P.WS}]+', ' ')})"


def strip_ws(e):
    return rx_replace(e, rf"^[{P.WS}]+|[{P.WS}]+\z", "")


def clean_headline(e: str) -> str:
    t = f"coalesce({e}, '')"
    t = ascii_fold(t)
    t = normalize_punct(t)
    t = replace_money(t)
    t = rx_replace(t, P.END_PERIOD_RE, P.END_PERIOD_TOKEN)
    t = f"lower({t})"
    t = rx_replace(t, P.CLEAN_DROP_RE, " ")
    return collapse_ws(t)


def strip_title_suffix(e, suffixes=None):
    return strip_ws(rx_replace(e, P.suffix_regex(suffixes), ""))


def dedupe_key(e):
    return rx_replace(f"lower({e})", "[^a-z0-9]+", "")


# --- counts and tokens ------------------------------------------------------

def word_count(e):
    return f"CAST({rx_count(e, P.NON_WS_RUN)} AS BIGINT)"


def ws_tokens(e):
    return f"regexp_extract_all({e}, {q(P.NON_WS_RUN)})"


def word_runs(e):
    return f"regexp_extract_all({e}, {q(P.WORD_RUN)})"


def marker_word_count(e, words=None):
    ws = P.MARKER_WORDS if words is None else words
    return (f"CAST(len(list_distinct(list_intersect({word_runs(f'lower(coalesce({e}, {chr(39)}{chr(39)}))')}, "
            f"{lst(ws)}))) AS BIGINT)")


def marker_char_count(e):
    return f"CAST({rx_count(e, P.marker_char_class())} AS BIGINT)"


def marker_ratio(e, words=None):
    ws = P.MARKER_WORDS if words is None else words
    toks = (f"list_filter({word_runs(f'lower(coalesce({e}, {chr(39)}{chr(39)}))')}, "
            f"lambda w: regexp_full_match(w, {q('[' + P.RATIO_LETTERS + ']+')}))")
    return (f"(len(list_filter({toks}, lambda w: list_contains({lst(ws)}, w)))::DOUBLE "
            f"/ greatest(len({toks}), 1))")


def artifact_any(e):
    parts = [f"coalesce({rx_has(e, P.artifact_regex(body, ci, 're2'))}, false)"
             for _, body, ci in P.ARTIFACT_RULES]
    return "(" + " OR ".join(parts) + ")"


def word_tokens(e, default_pattern=False):
    pat = P.DEFAULT_TOKEN_RE if default_pattern else P.WORD_TOKEN_RE
    return f"regexp_extract_all(lower(coalesce({e}, '')), {q(pat)})"


def word_ngrams(toks: str, n_min=1, n_max=2) -> str:
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(toks)
        else:
            parts.append(
                f"CASE WHEN len({toks}) >= {n} THEN list_transform(generate_series(1, len({toks}) - {n - 1}), "
                f"lambda i: array_to_string(list_slice({toks}, i, i + {n - 1}), ' ')) ELSE []::VARCHAR[] END")
    out = parts[0]
    for p_ in parts[1:]:
        out = f"list_concat({out}, {p_})"
    return out


def char_wb_ngrams(e, n_min, n_max):
    words = ws_tokens(f"lower(coalesce({e}, ''))")
    return (
        f"flatten(list_transform({words}, lambda w: flatten(list_transform("
        f"list_filter(generate_series({n_min}, {n_max}), lambda n: n = {n_min} OR n - 1 < length(w) + 2), "
        f"lambda n: list_transform(generate_series(0, greatest(length(w) + 2 - n, 0)), "
        f"lambda i: substring(' ' || w || ' ', i + 1, n))))))"
    )


# --- style ------------------------------------------------------------------

def style_exprs(e: str) -> dict[str, str]:
    s = f"coalesce({e}, '')"
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    return {
        "len": f"length({s})",
        "n_periods": rx_count(s, r"\."),
        "has_end_period": f"CAST({rx_has(s, P.END_PERIOD_RE)} AS INT)",
        "has_U_S": f"CAST(contains({s}, 'U.S.') AS INT)",
        "has_US": f"CAST(list_contains({word_runs(s)}, 'US') AS INT)",
        "has_colon": f"CAST(contains({s}, ':') AS INT)",
        "n_caps": rx_count(s, "[A-Z]"),
        "n_allcaps": (f"len(list_filter({ws_tokens(s)}, lambda w: regexp_matches(w, '\\p{{Lu}}') "
                      f"AND NOT regexp_matches(w, '[\\p{{Ll}}\\p{{Lt}}]') AND length(w) > 2))"),
        "has_quote": f"CAST({rx_has(s, '[\"' + chr(39) + '`]')} AS INT)",
        "has_sing_quote": f"CAST(contains({s}, {q(chr(39))}) AS INT)",
        "is_title_case": (f"CAST(({rx_has(s, r'[\p{Lu}\p{Lt}]')} AND NOT {rx_has(s, rf'(^|[^{cased}])\p{{Ll}}')} "
                          f"AND NOT {rx_has(s, rf'[{cased}][\p{{Lu}}\p{{Lt}}]')}) AS INT)"),
        "has_hyphen": f"CAST({rx_has(s, rf'[{P.WORD}]-[{P.WORD}]')} AS INT)",
    }


def style_select(e: str) -> str:
    ex = style_exprs(e)
    return ", ".join(f"CAST({ex[n]} AS DOUBLE) AS {n}" for n in P.STYLE_FEATURES)
