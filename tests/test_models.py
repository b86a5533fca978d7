"""The forests of ``forest_metrics``: both labels are learned, and a model that learned nothing shows."""

from pyspark.sql import functions as F

from conftest import DATA
from ledgerline.catalog import QUERIES
from ledgerline.operators import features


def test_both_labels_are_fitted_and_a_lost_input_shows(spark, monkeypatch):
    fitted, fit = [], features.fit_forest

    def blind(train, inputs, label, **params):
        fitted.append((label, tuple(inputs), params["depth"]))
        score = fit(train.withColumn(label, F.lit(1.0)) if label == "gross" else train, inputs, label, **params)
        return score

    monkeypatch.setattr(features, "fit_forest", blind)
    rows = {(r.experiment, r.run_id): r for r in QUERIES["forest_metrics"](spark, DATA).collect()}
    assert sorted(fitted) == [(x, y, d) for x, y in (("gross", ("qty", "lines")), ("o_totalprice", ("qty", "lines", "gross"))) for d in (3, 5)]
    assert all(r.better_than_mean is False and not r.no_worse_than_mean for (e, _), r in rows.items() if e == "order_value")
    assert all(r.no_worse_than_mean for (e, _), r in rows.items() if e == "order_price") and len(rows) == 4
