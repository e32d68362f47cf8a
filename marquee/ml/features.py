"""Feature pipelines as ``pyspark.ml`` stages.

Text stages are small Python ``Transformer`` classes whose ``_transform`` is
native column expressions (no UDF); they end in arrays of words. ``TfidfVectorizer``
is an ``Estimator`` that fits the vocabulary and idf with DataFrame jobs on the rows
it is given (so each CV fold fits its own), then returns ``TermCounts`` (fixed vocabulary,
alphabetical indices), ``ElementwiseProduct`` (idf + 1) and ``Normalizer`` (L2). The
vocabulary taken to the driver is bounded by ``maxFeatures``.

``FeaturePipeline`` fits all of it from two written tables: the words of every text,
which the vocabularies are counted from, and the term counts, which give
document frequencies, scales and features. Character n-grams are counted from the
distinct words and their numbers: no text's n-grams are ever listed.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import IDF, ElementwiseProduct, MaxAbsScaler, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import stopwords
from marquee.functions import text as T
from marquee.functions.style import style_columns
from marquee.ml.term_vectors import TermCounts
from marquee.operators import vocab as V
from marquee.session import checkpoint_dir

MAX_VOCAB = 1 << 20


class _ColStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Base of single-column text stages (subclasses set params in __init__)."""

    def _expr(self, c):
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self._expr(F.col(self.getInputCol())))


class CleanText(_ColStage):
    """Headline cleaner (fold, punctuation, money, end period, lower, collapse)."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _expr(self, c):
        return T.clean_headline(c)


class WordTerms(_ColStage):
    """Lowercased word tokens -> optional stop-word removal."""
    pattern = Param(Params._dummy(), "pattern", "custom | default", TypeConverters.toString)
    stopWords = Param(Params._dummy(), "stopWords", "remove English stop words", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, pattern="custom", stopWords=False):
        super().__init__()
        self._setDefault(pattern="custom", stopWords=False)
        self._set(**self._input_kwargs)

    def _expr(self, c):
        toks = T.word_tokens(c, self.getOrDefault("pattern") == "default")
        return T.remove_stopwords(toks, stopwords.english()) if self.getOrDefault("stopWords") else toks


class CharWords(_ColStage):
    """The lowercased words that ``char_wb`` n-grams are cut from."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _expr(self, c):
        return T.char_wb_words(c)


class StyleFeatures(_ColStage):
    """The 12 style features of the raw text, assembled into one vector."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"_style_{n}" for n in P.STYLE_FEATURES]
        cols = [c.alias(n) for c, n in zip(style_columns(self.getInputCol()), names)]
        staged = df.select("*", *cols)
        out = VectorAssembler(inputCols=names, outputCol=self.getOutputCol()).transform(staged)
        return out.drop(*names)


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    cols = Param(Params._dummy(), "cols", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, cols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.drop(*self.getOrDefault("cols"))


def occurrences(df: DataFrame, ic: str, n_min: int, n_max: int, by: list[str] = ()) -> DataFrame:
    """(*by, term, n) whose sums are the totals of the terms; character n-grams are cut from the distinct words in ``ic``."""
    if not n_min:
        return V.exploded(df.select(*by, T.word_ngrams(F.col(ic), 1, n_max).alias("_x")), "_x", list(by)).withColumn("n", F.lit(1))
    words = V.exploded(df, ic, list(by)).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))
    return words.select(*by, F.explode(T.char_wb_of_words(F.array("term"), n_min, n_max)).alias("term"), "n")


def listed_terms(ic: str, n_min: int, n_max: int) -> F.Column:
    """Every term of a row, repeats included."""
    return T.char_wb_of_words(F.col(ic), n_min, n_max) if n_min else T.word_ngrams(F.col(ic), 1, n_max)


def tfidf_stages(terms: list[str], idf: list[float], ic: str, oc: str, sublinear: bool, n_min: int = 0, n_max: int = 1) -> list:
    """Stages from a word array to its L2-normalized tf-idf vector, for a given vocabulary."""
    tf_col, w_col = f"_{oc}_tf", f"_{oc}_w"
    return [TermCounts(vocabulary=terms, nMin=n_min, nMax=n_max, sublinear=sublinear, inputCol=ic, outputCol=tf_col),
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=tf_col, outputCol=w_col),
            Normalizer(p=2.0, inputCol=w_col, outputCol=oc), DropColumns(cols=[tf_col, w_col])]


class TfidfVectorizer(Estimator, HasInputCol, HasOutputCol):
    """Word array -> L2-normalized tf-idf vector with smoothed idf + 1; ``nMin`` 0 for words, else character n-grams."""
    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary cap", TypeConverters.toInt)
    minDf = Param(Params._dummy(), "minDf", "minimum document frequency", TypeConverters.toInt)
    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(tf)", TypeConverters.toBoolean)
    nMin = Param(Params._dummy(), "nMin", "smallest n of character n-grams, 0 for words", TypeConverters.toInt)
    nMax = Param(Params._dummy(), "nMax", "largest n", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, maxFeatures=5000, minDf=1, sublinear=False, nMin=0, nMax=1):
        super().__init__()
        self._setDefault(maxFeatures=5000, minDf=1, sublinear=False, nMin=0, nMax=1)
        self._set(**self._input_kwargs)

    def terms(self, df: DataFrame) -> list[str]:
        """The vocabulary, alphabetical."""
        ic, n_min, n_max = self.getInputCol(), self.getOrDefault("nMin"), self.getOrDefault("nMax")
        max_features, min_df = self.getOrDefault("maxFeatures"), self.getOrDefault("minDf")
        if not 0 < max_features <= MAX_VOCAB:   # whatever the data: the vocabulary comes to the driver
            raise ValueError(f"maxFeatures must lie in 1..{MAX_VOCAB}")
        if min_df > 1:                                    # document frequencies of all terms decide
            stats = V.term_totals(df.select(ic), listed_terms(ic, n_min, n_max))
        else:
            stats = occurrences(df, ic, n_min, n_max).groupBy("term").agg(F.sum("n").alias("total"))
        return [r["term"] for r in V.select_terms(stats, max_features, min_df).orderBy("idx").select("term").collect()] or ["\u0000"]

    def counts(self, terms: list[str]) -> TermCounts:
        return TermCounts(vocabulary=terms, nMin=self.getOrDefault("nMin"), nMax=self.getOrDefault("nMax"), sublinear=self.getOrDefault("sublinear"),
                          inputCol=self.getInputCol(), outputCol=f"_{self.getOutputCol()}_tf")

    def from_counts(self, counted: DataFrame, counts: TermCounts) -> Model:
        """The model, from rows with the output of ``counts``."""
        terms = counts.getOrDefault("vocabulary")
        idf = [0.0] if terms == ["\u0000"] else smoothed_idf(counted, counts.getOutputCol())
        return TfidfModel(PipelineModel(tfidf_stages(terms, idf, self.getInputCol(), self.getOutputCol(), self.getOrDefault("sublinear"),
                                                     self.getOrDefault("nMin"), self.getOrDefault("nMax"))))

    def _fit(self, df: DataFrame) -> Model:
        counts = self.counts(self.terms(df))
        return self.from_counts(counts.transform(df), counts)


def smoothed_idf(counted: DataFrame, col: str) -> list[float]:
    """ln((1 + n) / (1 + df)) + 1 of every place of a column of counts."""
    m = IDF(inputCol=col, outputCol="_idf").fit(counted.select(col))
    return [math.log((1 + m.numDocs) / (1 + d)) + 1 for d in m.docFreq]


class TfidfModel(Model):
    def __init__(self, inner: PipelineModel | None = None):
        super().__init__()
        self.inner = inner

    def _transform(self, df):
        return self.inner.transform(df)

    @property
    def vocabulary(self) -> list[str]:
        return list(self.inner.stages[0].getOrDefault("vocabulary"))


@dataclass(frozen=True)
class FeatureConfig:
    """One named feature pipeline (word / char / style branches)."""
    name: str
    clean: bool = False
    word_pattern: str | None = "custom"     # None = no word branch
    word_max: int = 5000
    word_ngram: int = 1
    word_stop: bool = False
    word_min_df: int = 1
    word_sublinear: bool = False
    char_range: tuple[int, int] | None = None
    char_max: int = 2500
    char_min_df: int = 1
    char_sublinear: bool = False
    style: bool = False
    maxabs: bool = False


# The eight feature pipelines of the model-selection study.
CONFIGS = {
    "Baseline": FeatureConfig("Baseline", word_pattern="default", word_max=100, word_stop=True),
    "Cleaned": FeatureConfig("Cleaned", clean=True, word_max=100, word_stop=True),
    "Optimized_v2": FeatureConfig("Optimized_v2", word_pattern="default", word_max=5000, word_ngram=2,
                                  word_sublinear=True, word_stop=True),
    "Optimized_v2_tokenized": FeatureConfig("Optimized_v2_tokenized", clean=True, word_max=5000, word_ngram=2,
                                            word_sublinear=True, word_min_df=2, word_stop=True),
    "V3_char_grams": FeatureConfig("V3_char_grams", clean=True, word_pattern=None, char_range=(3, 5),
                                   char_max=5000, char_sublinear=True, char_min_df=2),
    "Hybrid": FeatureConfig("Hybrid", clean=True, word_max=2500, word_ngram=2, char_range=(3, 5), char_max=2500),
    "Hybrid_v1": FeatureConfig("Hybrid_v1", clean=True, word_max=5000, word_ngram=2, word_stop=True,
                               char_range=(4, 6), char_max=5000),
    "Hybrid_v2_style": FeatureConfig("Hybrid_v2_style", word_max=2500, word_ngram=2, char_range=(3, 5),
                                     char_max=2500, style=True, maxabs=True),
}
# Hybrid_v2_style after its feature grid search: 5000 words, char (4, 6).
SHIPPED = FeatureConfig("Hybrid_v2_style", word_max=5000, word_ngram=2, char_range=(4, 6),
                        char_max=2500, style=True, maxabs=True)


def text_stages(cfg: FeatureConfig, text_col: str = "headline") -> list:
    """Stages without anything to fit: from the text to words and style."""
    src = "_clean" if cfg.clean else text_col
    stages = [CleanText(inputCol=text_col, outputCol="_clean")] if cfg.clean else []
    if cfg.word_pattern is not None:
        stages.append(WordTerms(inputCol=src, outputCol="_wterms", pattern=cfg.word_pattern, stopWords=cfg.word_stop))
    if cfg.char_range is not None:
        stages.append(CharWords(inputCol=src, outputCol="_cterms"))
    if cfg.style:
        stages.append(StyleFeatures(inputCol=text_col, outputCol="_style"))
    return stages


def vectorizers(cfg: FeatureConfig) -> list[TfidfVectorizer]:
    out = []
    if cfg.word_pattern is not None:
        out.append(TfidfVectorizer(inputCol="_wterms", outputCol="_words", maxFeatures=cfg.word_max, minDf=cfg.word_min_df,
                                   sublinear=cfg.word_sublinear, nMax=cfg.word_ngram))
    if cfg.char_range is not None:
        out.append(TfidfVectorizer(inputCol="_cterms", outputCol="_chars", maxFeatures=cfg.char_max, minDf=cfg.char_min_df,
                                   sublinear=cfg.char_sublinear, nMin=cfg.char_range[0], nMax=cfg.char_range[1]))
    return out


_OWN = ["_clean", "_wterms", "_cterms", "_words", "_chars", "_style", "_features_raw"]


def fit_features(cfg: FeatureConfig, df: DataFrame, fitted_on: F.Column | None = None, text_col: str = "headline") -> tuple[list, DataFrame]:
    """(fitted stages, ``df`` without its text but with written features), fitted on the rows that ``fitted_on`` holds for.

    Every text is cut into words once, and their terms are counted once: both tables are written and read again."""
    checkpoint_dir(df.sparkSession)
    text, makers = text_stages(cfg, text_col), vectorizers(cfg)
    keep = [c for c in df.columns if c != text_col]
    words = PipelineModel(text).transform(df).select(*keep, *[m.getInputCol() for m in makers], *(["_style"] if cfg.style else [])).checkpoint()

    def side(x: DataFrame) -> DataFrame:
        return x if fitted_on is None else x.where(fitted_on)
    with ThreadPoolExecutor(max_workers=2) as ex:
        counts = list(ex.map(lambda m: m.counts(m.terms(side(words))), makers))
    counted = PipelineModel(counts).transform(words).drop(*[m.getInputCol() for m in makers]).checkpoint()
    with ThreadPoolExecutor(max_workers=2) as ex:
        models = list(ex.map(lambda m, c: m.from_counts(side(counted), c), makers, counts))
    raw = "_features_raw" if cfg.maxabs else "features"
    rest = [VectorAssembler(inputCols=[m.getOutputCol() for m in makers] + (["_style"] if cfg.style else []), outputCol=raw)]
    # behind the counts the stages are those of the models
    out = PipelineModel([s for m in models for s in m.inner.stages[1:]] + rest).transform(counted)
    if cfg.maxabs:
        rest.append(MaxAbsScaler(inputCol=raw, outputCol="features").fit(side(out)))
        out = rest[-1].transform(out)
    rest.append(DropColumns(cols=_OWN))
    # in the order of the vector, each vectorizer behind its words
    after = {s.getOutputCol(): m for s, m in zip([s for s in text if not isinstance(s, (CleanText, StyleFeatures))], models)}
    stages = [x for s in text for x in ([s, after[s.getOutputCol()]] if s.getOutputCol() in after else [s])]
    return stages + rest, out.select(*keep, "features").checkpoint()


class FeaturePipeline(Estimator):
    """The features of a configuration and, behind them, a classifier."""

    def __init__(self, cfg: FeatureConfig, classifier=None, text_col: str = "headline"):
        super().__init__()
        self.cfg, self.classifier, self.text_col = cfg, classifier, text_col

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages, feats = fit_features(self.cfg, df, None, self.text_col)
        return PipelineModel(stages + ([self.classifier.fit(feats)] if self.classifier is not None else []))


def build_pipeline(cfg: FeatureConfig, classifier=None, text_col: str = "headline") -> FeaturePipeline:
    return FeaturePipeline(cfg, classifier, text_col)


def feature_names(model: PipelineModel) -> list[str]:
    """Names in vector order: words__t, chars__g, style__f (like a feature union)."""
    names = []
    for st in model.stages:
        if isinstance(st, TfidfModel):
            prefix = "words" if st.inner.stages[0].getInputCol() == "_wterms" else "chars"
            names += [f"{prefix}__{t}" for t in st.vocabulary]
        if isinstance(st, StyleFeatures):
            names += [f"style__{n}" for n in P.STYLE_FEATURES]
    return names
