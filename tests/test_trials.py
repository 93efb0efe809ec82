"""The registered searches run the declared number of trials."""

import pytest

from snapcredit.models.training import SearchResult
from snapcredit.plans import scorecard
from snapcredit.plans.catalog import modelling


@pytest.mark.parametrize("name", ["random_search", "cv_search", "scorecard"])
def test_declared_trials(spark, sf_dir, monkeypatch, name):
    sizes = []

    def search(estimator, grid, *args, **options):
        sizes.append(len(grid))
        return SearchResult(None, {}, {"val_auc": 0.5}, [{"cv_auc": 0.5} for _ in grid])

    for module, function in ((modelling, "random_search"), (modelling, "cv_search"), (scorecard, "cv_search")):
        monkeypatch.setattr(module, function, search)
    monkeypatch.setattr(scorecard, "model_card", lambda *args: None)
    from snapcredit.plans.catalog import QUERIES

    QUERIES[name](spark, sf_dir)
    assert sizes == [100]
