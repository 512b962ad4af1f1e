"""The registered model queries fit the whole model."""

from tidewatch import queries as registered
from tidewatch.plans import training as M


def test_registered_queries_take_all_rounds_and_folds(spark, sf_dir):
    assert registered.SETTINGS == M.FULL_SETTINGS
    assert (registered.SETTINGS.rounds, registered.SETTINGS.folds) == (300, 5)
    trees = registered._fitted(spark, sf_dir)[1].stages[-1]
    assert trees.getNumTrees == 300
    folds = registered._feature_table(spark, sf_dir).select("fold").distinct().count()
    assert folds == 5
