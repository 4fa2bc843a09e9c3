"""Lookups of category statistics: one array a category, by fit fold."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import categorical as cat


def test_lookup_is_an_array_by_fit_fold(spark):
    rows = [(1, "a", 1, 1.0), (2, "a", 2, 3.0), (3, "b", 3, 5.0), (4, None, 3, 7.0)]
    train = spark.createDataFrame(rows, "id long, c string, fold int, y double").withColumn("split", F.lit("train"))
    cs = cat.CategoryStats(train, ["c"], 3, y_col="y", card=cat.cardinalities(train, ["c"]))
    table, _, _ = cs.lookup("c", F.col("n").cast("double"), "n_of")
    assert isinstance(table.schema["n_of"].dataType, T.ArrayType)
    # b and the missing one have rows in fold 3 only, so the fit without it has none
    assert {r["n_of_k"]: r["n_of"] for r in table.collect()} == {"a": [1.0, 1.0, 2.0], "b": [1.0, 1.0, None], cat.MISSING_TOKEN: [1.0, 1.0, None]}
    known, _, _ = cs.lookup("c", F.lit(True), "known", null_rows=False)
    assert {r["known_k"] for r in known.collect()} == {"a", "b"}
    fitted = cat.fit_target(cs, 1.0)
    got = fitted.transform(train, 3, ["id", "fit_fold"]).where("id = 3").orderBy("fit_fold").collect()
    mean = {1: 5.0, 2: 13.0 / 3, 3: 2.0}
    assert [r[2] for r in got] == [(5.0 + mean[1]) / 2, (5.0 + mean[2]) / 2, mean[3]]
    cs.release()


def test_tree_families_read_stored_features(spark, monkeypatch):
    from foldwise import catalog
    from foldwise.plans import evaluate as ev
    given = []

    def look(feat, *_, **__):
        given.append(type(feat))
        raise InterruptedError
    monkeypatch.setattr(ev, "cross_validate", look)
    for name in ("random_forest_cv", "boosted_cv"):
        try:
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        except InterruptedError:
            pass
    assert given == [ev.StoredFeatures] * 2
