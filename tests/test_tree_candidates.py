"""Classification trees grown from codes against MLlib's on one-hot columns."""

from larch.plans import experiments as ex, training as tr
from larch.operators import models
from tests.conftest import SF01


def test_tree_from_codes_equals_mllib_on_one_hot_columns(spark):
    codes = tr.prepare(spark, SF01, "classification", enable_categorical=True)
    onehot = tr.prepare(spark, SF01, "classification")
    found = ex.tree_candidates(codes, [{"max_depth": 4}], "decision_tree")[0]["metrics"]
    _, known = tr.fit_and_evaluate(onehot, models.decision_tree(onehot.label, 4))
    assert {k: round(v, 9) for k, v in found.items()} == {k: round(v, 9) for k, v in known.items()}
    forest = ex.tree_candidates(codes, [{"n_estimators": 4, "max_depth": 3, "max_features": 0.6, "min_samples_leaf": 0.05}], "random_forest")[0]["metrics"]
    assert forest["roc_auc_test"] > 0.8 and forest == ex.tree_candidates(codes, [{"n_estimators": 4, "max_depth": 3, "max_features": 0.6, "min_samples_leaf": 0.05}], "f")[0]["metrics"]
    # no name per one-hot column travels with the frame
    assert set(onehot.frame.schema["features"].metadata["ml_attr"]) == {"num_attrs"}
    codes.release()
    onehot.release()
