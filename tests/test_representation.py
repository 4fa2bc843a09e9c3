import pytest

from foldwise.operators.representation import Representation


def test_id_is_stable_and_order_sensitive():
    a = Representation(["standardize_numeric", {"id": "target_encode_categoricals", "smoothing": 2.0}])
    b = Representation(["standardize_numeric", {"id": "target_encode_categoricals", "smoothing": 2.0}])
    c = Representation([{"id": "target_encode_categoricals", "smoothing": 2.0}, "standardize_numeric"])
    assert a.id == b.id and a.id.startswith("repr-") and len(a.id) == 13
    assert a.id != c.id


@pytest.mark.parametrize("spec", [
    [{"id": "rare_category_bucket", "min_frequency": 1.5}],
    [{"id": "target_encode_categoricals", "smoothing": -1}],
    [{"id": "onehot_encode_low_cardinality_categoricals", "max_cardinality": 0}],
    [{"id": "standardize_numeric", "unexpected": 1}],
    ["no_such_operator"],
])
def test_parameter_validation(spec):
    with pytest.raises(ValueError):
        Representation(spec)


def test_pruner_threshold_checked():
    with pytest.raises(ValueError):
        Representation(["standardize_numeric"], [{"id": "high_correlation_prune", "threshold": 1.5}])


def test_matrix_kind():
    assert Representation(["standardize_numeric"]).matrix_kind() == "dense"
    assert Representation(["standardize_numeric", "quantile_bin_numeric"]).matrix_kind() == "sparse"
    assert Representation(["native_numeric", "native_categorical"]).matrix_kind() == "native"
    with pytest.raises(ValueError):
        Representation(["native_numeric", "quantile_bin_numeric"]).matrix_kind()
