"""Folds run side by side only as far as memory holds their cached rows."""

import threading

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwise.plans import evaluate as ev
from foldwise.plans import models as md


def test_folds_wait_for_memory(spark, monkeypatch):
    rows = spark.range(60).select("id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("fit_fold"), (F.col("id") % 7).cast("double").alias("y"),
                                  array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 5).cast("double"))).alias("features"))
    rows = rows.withColumn("role", F.when(F.col("id") % 3 + 1 == F.col("fit_fold"), "valid").otherwise("train"))
    feat = ev.StoredFeatures.write(rows.select("id", "fit_fold", "role", "y", "features"), 2)
    family = md.resolve("gradient_boosted_trees", "regression")
    assert feat.train_rows() == 40
    need = 40 * (ev.ROW_BYTES + 4 * 3)
    running, most, lock = set(), [], threading.Lock()
    build = family.build

    def watched(train, p):
        estimator = build(train, p)
        fit = estimator.fit

        def slow(data):
            with lock:
                running.add(threading.get_ident())
                most.append(len(running))
            try:
                return fit(data)
            finally:
                with lock:
                    running.discard(threading.get_ident())
        estimator.fit = slow
        return estimator
    watching = md.ModelFamily(family.name, family.task, watched, params=family.params)
    wanted = {"n_estimators": 1, "max_depth": 2}
    got = {}
    for room, at_once in ((2 * need, 1), (4 * need, 2), (100 * need, 3), (1, 1)):
        monkeypatch.setattr(ev, "storage_bytes", lambda _, room=room: room)
        assert ev.folds_at_once(spark, feat, watching, wanted, 3) == at_once
        most.clear()
        got[room] = sorted(map(tuple, ev.oof(ev.cross_validate(feat, ["a", "b"], "y", watching, 3, wanted, score_only=True)).collect()))
        assert len(most) == 3 and max(most) <= at_once
    assert len(got[1]) == 60 and all(v == got[1] for v in got.values())
    # two cross-validations in flight share the memory; plans without cached rows don't wait
    monkeypatch.setattr(ev, "storage_bytes", lambda _: 4 * need)
    assert ev.folds_at_once(spark, feat, watching, wanted, 3, share=2) == 1
    assert ev.folds_at_once(spark, feat, md.resolve("naive_bayes", "binary"), {}, 3) == 3


def test_storage_bytes_of_the_session(spark):
    assert ev.storage_bytes(spark) > 1 << 20
