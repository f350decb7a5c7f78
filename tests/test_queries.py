from conftest import SF_SMALL

from riskframe.plans import queries as Q


def test_random_search_takes_all_training_rows(spark, monkeypatch):
    monkeypatch.setattr(Q.TU, "random_search", lambda make, dists, df, key, **options: (df, None, None))
    searched = Q.QUERIES["random_search"](spark, SF_SMALL)
    assert searched.count() == Q._prepared(spark, SF_SMALL)[0].count()
    assert {r.fold for r in searched.select("fold").distinct().collect()} == {0, 1, 2}
