"""marquee: headline analytics and two-class source attribution on Spark.

Layout:
  functions/  Column -> Column text, fold, style and regex expressions
  sources/    readers/writers: headline tables, landed pages, feeds, models
  operators/  DataFrame -> DataFrame filters, corpus ops, statistics, vocab, metrics
  ml/         pyspark.ml feature stages, learners, tuning and ensembles
  plans/      end-to-end compositions (prepare, corpus merge, train, score)
  streaming/  the same stateless stages applied to a readStream source
"""

__version__ = "0.1.0"
