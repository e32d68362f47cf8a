from pyspark.sql import functions as F

from marquee.operators import corpus as C


def test_keep_first_under_skew(spark):
    hot = [(i, "hot", "A" if i % 3 else "B") for i in range(1, 3001)]
    df = spark.createDataFrame(hot + [(0, "cold", "B"), (5000, "cold", "A")], "row_id long, headline string, source string")
    got = {r["headline"]: (r["row_id"], r["source"]) for r in C.dedupe_first(df).collect()}
    assert got == {"hot": (1, "A"), "cold": (0, "B")}


def test_balance_exact_sizes(spark):
    df = spark.createDataFrame([(i, f"h{i}", "A" if i < 700 else "B") for i in range(1000)],
                               "row_id long, headline string, source string")
    out = C.balance_classes(df)
    sizes = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    assert sizes == {"A": 300, "B": 300}
    again = C.balance_classes(df.repartition(7))
    assert sorted(r[0] for r in out.select("row_id").collect()) == sorted(r[0] for r in again.select("row_id").collect())


def test_stratified_folds_match_reference_allocation(spark):
    labels = [1] * 37 + [0] * 21 + [1] * 5
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "row_id long, label int")
    got = [r["fold"] for r in C.stratified_folds(df, 5).orderBy("row_id").collect()]
    # a class is dealt in consecutive blocks; per fold, the counts differ by one row at most
    for y in (0, 1):
        own = [f for f, lab in zip(got, labels) if lab == y]
        assert own == sorted(own) and max(map(own.count, range(5))) - min(map(own.count, range(5))) <= 1
    assert max(map(got.count, range(5))) - min(map(got.count, range(5))) <= 1


def test_folds_and_cuts_against_ranked_rows(spark):
    import hashlib
    labels = {i: (i * 7919) % 13 % 3 for i in range(0, 900, 3)}
    df = spark.createDataFrame([(i, y, "x" * 50) for i, y in labels.items()] + [(9001, None, "y")],
                               "row_id long, label int, text string").repartition(5)
    k, flat = 5, sorted(labels.values())
    want = {}
    for y in set(flat):
        per = [sum(1 for j in range(f, len(flat), k) if flat[j] == y) for f in range(k)]
        own = sorted(i for i, v in labels.items() if v == y)
        want.update(zip(own, [f for f in range(k) for _ in range(per[f])]))
    assert {r["row_id"]: r["fold"] for r in C.stratified_folds(df, k).collect()} == want

    def order(i):
        return hashlib.md5(f"{i}:42".encode()).hexdigest(), i
    split = {r["row_id"]: r["is_test"] for r in C.split_stratified(df).collect()}
    small = min(flat.count(y) for y in set(flat))
    kept = {r["row_id"] for r in C.balance_classes(df, "label").collect()}
    for y in set(flat):
        own = sorted((i for i, v in labels.items() if v == y), key=order)
        assert [split[i] for i in own] == [n < -(-len(own) // 5) for n in range(len(own))]
        assert kept & set(own) == set(own[:small])
    assert set(split) == set(labels) and C.balance_classes(df.where("false"), "label").count() == 0


def test_ids_of_the_whole_range(spark):
    ids = [-2 ** 63, -5, 0, 7, 2 ** 62, 2 ** 63 - 1]
    df = spark.createDataFrame([(i, 1) for i in ids], "row_id long, label int")
    got = {r["row_id"]: r["fold"] for r in C.stratified_folds(df, 3).collect()}
    assert [got[i] for i in ids] == [0, 0, 1, 1, 2, 2]


def test_splits(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(101)], "row_id long, label int")
    r = C.split_random(df).where("is_test").count()
    assert r == 21  # ceil(0.2 * 101)
    s = {x[0]: x[1] for x in C.split_stratified(df).where("is_test").groupBy("label").count().collect()}
    assert s == {1: 6, 0: 15}  # ceil(0.2 * 26), ceil(0.2 * 75)


def test_merge_corpus(spark):
    base = spark.createDataFrame([(1, "https://www.FOXNEWS.com/a", "Big News Today"), (2, "https://nbc.com/b", None)],
                                 "row_id long, url string, headline string")
    new = spark.createDataFrame([(10, "big news, today!", "NBC"), (11, "Other story", "FoxNews"),
                                 (12, "Other story", "FoxNews"), (13, "Third one", "NBC"), (14, "???", "NBC")],
                                "row_id long, headline string, source string")
    out = {r["row_id"]: (r["source"], r["origin"]) for r in C.merge_corpus(base, new).collect()}
    assert out[1] == ("FoxNews", "base") and 2 not in out
    assert 10 not in out and 12 not in out          # normalized duplicate of base; exact duplicate
    assert sum(1 for v in out.values() if v[1] == "new") <= 2


def test_query_grid_size(spark):
    two = spark.createDataFrame([("FoxNews",), ("NBC",)], "source string")
    g = C.query_grid(two)
    assert g.count() == 7240
    assert g.agg(F.min("after"), F.max("before")).first()[1].isoformat() == "2026-05-01"


def test_terms_are_counted_in_bounded_shares_of_the_texts(spark, monkeypatch):
    """The partitions of texts clustered by row follow the bytes of their table, so a task's terms do not grow with it."""
    from pyspark.sql import functions as F
    from marquee.plans import catalog, fixtures
    from testing_data import SF001
    monkeypatch.setattr(fixtures, "SHARE_BYTES", 4096)
    files = spark.read.format("binaryFile").load(f"{SF001}/documents.parquet").agg(F.sum("length")).first()[0]
    docs = catalog._by_row(catalog._clean_docs(spark, SF001), SF001)
    assert docs.rdd.getNumPartitions() == -(-files // 4096) > spark.sparkContext.defaultParallelism
    assert docs.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_encoding_cuts_a_text_once(spark):
    """Tokens and padding come from one tokenisation of each row."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType, StringType
    from marquee.operators import vocab as V
    calls = spark.sparkContext.accumulator(0)

    def cut(text):
        calls.add(1)
        return text.split()
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "b c d e")], "row_id long, h string")
    index = spark.createDataFrame([("a", 2), ("b", 3)], "token string, idx int")
    got = V.encode(docs, F.udf(cut, ArrayType(StringType()))("h"), index, max_len=3).collect()
    assert sorted((r["row_id"], r["pos"], r["idx"]) for r in got) == [
        (1, 0, 2), (1, 1, 3), (1, 2, 2), (2, 0, 0), (2, 1, 0), (2, 2, 0), (3, 0, 3), (3, 1, 1), (3, 2, 1)]
    assert calls.value == 3
