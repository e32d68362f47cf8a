"""Word lists, regexes and names shared by the Spark code and the SQL oracle.

Regexes are written in the common subset of Java regex (Spark) and RE2
(DuckDB): explicit classes instead of ``\\w``/``\\s``/``\\d``/``\\b`` (both
engines default those to ASCII, Python does not), ``\\x{..}`` escapes, and
``\\z`` for "end of text". Python's ``$`` also matches before one final
newline, which is written here as ``\\n?\\z``.
"""

from __future__ import annotations

# Python's whitespace (str.split(), str.strip(), re \s on str patterns).
WS = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# The characters outside WS as plain ranges, frequent ones first: Java tries the ranges of a class in turn.
NON_WS = (r"!-~\x{a1}-\x{167f}\x{00}-\x{08}\x{0e}-\x{1b}\x{7f}-\x{84}\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
          r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}")
# Python's \w on str patterns.
WORD = r"\p{L}\p{N}_"
WORD_RUN = f"[{WORD}]+"
NON_WS_RUN = f"[^{WS}]+"
PY_END = r"\n?\z"

# ---------------------------------------------------------------------------
# These must equal the reference's values for identical results.
# ---------------------------------------------------------------------------
# Language-marker words (37), in the reference's order.
MARKER_WORDS = [
    "el", "la", "los", "las", "un", "una", "del", "por", "que", "con",
    "ante", "más", "también", "según", "está", "fue", "han", "era", "pero",
    "ser", "de", "en", "se", "su", "al", "le", "si", "ya", "hay", "uno",
    "dos", "tres", "y", "unos", "para", "como", "contra",
]
# Language-marker characters.
MARKER_CHARS = "«»ñ¿¡áéíóúÁÉÍÓÚ"
# Letters a ratio token may consist of.
RATIO_LETTERS = "a-záéíóúñü"
# Pass thresholds: pass 1 drops > 2 words or > 2 chars; pass 2 keeps ratio <= 0.16.
MAX_MARKER_WORDS = 2
MAX_MARKER_CHARS = 2
MAX_MARKER_RATIO = 0.16
# Length bounds (characters, inclusive) and minimum word count.
MIN_CHARS, MAX_CHARS, MIN_WORDS = 25, 140, 4
# Unicode punctuation mapped to ASCII: en dash, em dash, left/right single
# quote, left/right double quote, no-break space.
PUNCT_FROM = "\u2013\u2014\u2018\u2019\u201c\u201d\u00a0"
PUNCT_TO = "--''\"\" "
# Money: currency signs and scale words, and the replacement token.
CURRENCY_SIGNS = "$£€¥"
SCALE_WORDS = ["hundred", "thousand", "million", "billion", "trillion", "k", "m", "b", "t"]
MONEY_TOKEN = "[MONEY]"
END_PERIOD_TOKEN = " [ENDPERIOD]"
# Outlets: class 1 name, its URL marker, class 0 name.
OUTLET_A = "FoxNews"
OUTLET_A_SITE = "foxnews.com"
OUTLET_B = "NBC"
# Title suffixes removed from feed titles, tried in this order.
TITLE_SUFFIXES = [" - Fox News", " - NBC News", " | Fox News", " | NBC News"]
# Page-artifact drops used by preparation: (name, python regex body, case-insensitive).
ARTIFACT_RULES = [
    ("page_reference", r" - Page \d+$", False),
    ("archive_page", r"^Articles\s*[–-]", False),
    ("show_preview", r"^Coming up on", True),
    ("site_map", r"^Video Site Map", True),
    ("radio_episode", r"- FOX News Radio$", False),
    ("nation_episode", r"- Fox Nation$", True),
    ("stream_promo", r"^Stream live news", True),
]
# Artifact checks of the exploratory report (all case-insensitive, six rules).
ARTIFACT_CHECKS = [
    ("'Page' references", r" - Page \d+$"),
    ("Archive pages", r"^Articles\s*[–-]"),
    ("Show previews", r"^Coming up on"),
    ("Site maps", r"^Video Site Map"),
    ("Fox News Radio episodes", r"- FOX News Radio$"),
    ("Fox Nation episodes", r"- Fox Nation$"),
]
# Style feature names, in output order.
STYLE_FEATURES = [
    "len", "n_periods", "has_end_period", "has_U_S", "has_US", "has_colon",
    "n_caps", "n_allcaps", "has_quote", "has_sing_quote", "is_title_case",
    "has_hyphen",
]
COUNT_STYLE_FEATURES = ["len", "n_periods", "n_caps", "n_allcaps"]
# Word token patterns: custom (keeps [money]/[endperiod]) and the default.
WORD_TOKEN_PYTHON = r"\[?[\w]{2,}\]?"
DEFAULT_TOKEN_PYTHON = r"\b\w\w+\b"
# Query grid of the corpus collector: topics and day window.
GRID_TOPICS = [
    "politics", "election", "congress", "immigration", "economy", "inflation",
    "jobs", "foreign policy", "ukraine", "israel", "china", "crime", "police",
    "supreme court", "healthcare", "education", "climate", "technology",
    "sports", "entertainment",
]
GRID_START = "2025-11-01"
GRID_END = "2026-04-30"
SEED = 42
# Neural vocabulary: padding and unknown indices, minimum count, sequence length.
PAD_INDEX, UNK_INDEX, VOCAB_MIN_FREQ, SEQ_LEN = 0, 1, 2, 30
# ---------------------------------------------------------------------------

# Translations of the Python regexes above into the shared dialect.
MONEY_BODY = (
    "[" + CURRENCY_SIGNS.replace("$", r"\$") + r"]\p{Nd}+(?:\.\p{Nd}+)?(?:[,\p{Nd}+]+)?"
    + f"(?:[{WS}]?(?:" + "|".join(SCALE_WORDS) + "))?"
)
END_PERIOD_RE = rf"\.[{WS}]*\z"
WORD_TOKEN_RE = rf"\[?[{WORD}]{{2,}}\]?"
DEFAULT_TOKEN_RE = rf"[{WORD}]{{2,}}"
CLEAN_DROP_RE = rf"[^a-z0-9{WS}'\-.\[\]:]"
# The same and white space, for folded lower-case text: the ASCII characters that are not kept.
CLEAN_DROP_ASCII = "".join(chr(i) for i in range(128) if not (chr(i).isalnum() or chr(i) in "'-.[]: "))

_ARTIFACT_TRANSLATION = {
    r" - Page \d+$": r" - Page \p{Nd}+" + PY_END,
    r"^Articles\s*[–-]": rf"^Articles[{WS}]*[–-]",
    r"^Coming up on": r"^Coming up on",
    r"^Video Site Map": r"^Video Site Map",
    r"- FOX News Radio$": r"- FOX News Radio" + PY_END,
    r"- Fox Nation$": r"- Fox Nation" + PY_END,
    r"^Stream live news": r"^Stream live news",
}


def case_insensitive(body: str, dialect: str = "java") -> str:
    """Python's re.IGNORECASE on str patterns folds Unicode; so do these."""
    return ("(?iu)" if dialect == "java" else "(?i)") + body


def artifact_regex(python_body: str, ci: bool, dialect: str = "java") -> str:
    body = _ARTIFACT_TRANSLATION[python_body]
    return case_insensitive(body, dialect) if ci else body


def money_regex(dialect: str = "java") -> str:
    return case_insensitive(MONEY_BODY, dialect)


def escape_literal(s: str) -> str:
    """Escape regex metacharacters the same way for Java and RE2."""
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ch for ch in s)


def suffix_regex(suffixes=None) -> str:
    sufs = TITLE_SUFFIXES if suffixes is None else suffixes
    return "(?:" + "|".join(escape_literal(s) for s in sufs) + r")\z"


def marker_char_class() -> str:
    return "[" + MARKER_CHARS + "]"


def ratio_token_re() -> str:
    return f"^[{RATIO_LETTERS}]+$"
