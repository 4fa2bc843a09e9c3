"""The family queries run every registered family."""

from pyspark.sql import functions as F

from foldwise.plans import models as md


def test_binary_families_oof_runs_every_binary_family(spark, monkeypatch):
    from foldwise import catalog, oracle_sql
    from foldwise.plans import evaluate as ev
    ran = []

    def look(feat, names, label, family, k, params=None, **_):
        ran.append(family.name)
        family.resolve_params(params)
        return spark.range(1).select("id", F.lit(1).alias("fit_fold"), F.lit("valid").alias("role"), F.lit(1.0).alias("y_true"), F.lit(0.5).alias("y_pred"))
    monkeypatch.setattr(ev, "cross_validate", look)
    rows = catalog.QUERIES["binary_families_oof"](spark, "/root/testdata/sf0.001").collect()
    registered = {name for name, task in md.REGISTRY if task == "binary"}
    assert sorted(ran) == sorted(registered)
    assert {r["family"] for r in rows} == registered
    assert all(f"('{name}')" in oracle_sql.QUERIES["binary_families_oof"] for name in registered)
