"""The best promoter scores have unique keys by construction, so they are not searched for heavy ones."""

from varloom.operators import joins, scores


def test_best_scores_are_computed_once(spark, monkeypatch):
    searched = []
    search = joins.heavy_keys
    monkeypatch.setattr(joins, "heavy_keys", lambda df, on: searched.append(df.columns) or search(df, on))
    df = spark.createDataFrame([("a", "g", "t1"), ("b", "g", "t2")], "id string, gene string, feature string")
    raw = spark.createDataFrame([("a", "g", 0.5), ("a", "g", -0.75)], "id string, gene string, promoterai double")
    got = scores.promoter_scores(df, raw).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", "g", "t1", -0.75), ("b", "g", "t2", None)]
    assert searched == [["id", "gene", "feature"]]
