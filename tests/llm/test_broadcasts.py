from kinrank.llm import simhash


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exploded_table_is_broadcast(spark, edges):
    """Spark sizes a table without the rows that an explode makes, so a join
    with one is a merge join however small it looks."""
    prints = spark.createDataFrame([(f"{i:032x}",) for i in range(50)], "fingerprint string")
    pairs = planned(simhash.near_pairs(prints))
    assert "SortMergeJoin" in pairs and "BroadcastExchange" not in pairs
    whole = planned(simhash.near_documents(edges))
    assert "SortMergeJoin" in whole and "BroadcastExchange" not in whole


def test_the_counts_of_near_documents_are_merged(spark, monkeypatch):
    seen = []
    real = simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: seen.append(planned(df)) or real(df, name))
    prints = spark.createDataFrame([(f"{i % 9:032x}",) for i in range(20)], "fingerprint string")
    got = simhash.near_counts(prints)
    assert "BroadcastExchange" not in planned(got) and not any("BroadcastExchange" in p for p in seen)
    whole = {r["fingerprint"]: r["n_near"] for r in got.collect()}
    near = [sum(1 for j in range(20) if j != i and j % 9 and (i % 9 ^ j % 9).bit_count() <= 7) for i in range(20)]
    assert whole == {f"{i % 9:032x}": near[i] for i in range(20) if i % 9}
