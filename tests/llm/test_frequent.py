from evidentia.llm.frequent import commonest


def test_commonest_is_bounded_and_the_top(spark):
    counts = spark.createDataFrame([(f"w{k}", 1 + k // 3) for k in range(300)], "word string, n long")
    got = [r.n for r in commonest(counts, 50).collect()]
    assert 30 < len(got) <= 50 and min(got) >= 84
    assert commonest(counts, 1).count() == 0 and commonest(counts.limit(0), 5).count() == 0 and commonest(counts, 1000).count() == 300
