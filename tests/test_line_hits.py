"""Phrases over line ends, found without sorting a document's tokens."""

from evidentia.operators import navigate, search

TEXTS = ["a b\nc\n\n# x\nd a", "b c d a b c d", "a a\na\n \na a a", "", "a\nb\nc\nd\na b c\nd", "c d a b\nc d a\nb\n\nc\nd"]


def test_matches_over_line_ends_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")
    lines = navigate.lines_table(docs, "k")
    for phrase in (["a"], ["a", "a"], ["a", "b"], ["a", "b", "c", "d"], ["b", "c", "d", "a", "b"]):
        want = set()
        for k, text in enumerate(TEXTS):
            placed = [(w, n, p) for n, line in enumerate(text.split("\n")) for p, w in enumerate(line.replace("#", " ").split())]
            want |= {(k, *placed[i][1:]) for i in range(len(placed)) if [x[0] for x in placed[i : i + len(phrase)]] == phrase}
        rows = [(r.k, r.line_no, p) for r in search.line_hits(lines, phrase, "k").collect() for p in r.starts]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_no_token_is_a_row_before_a_window(spark):
    lines = navigate.lines_table(spark.createDataFrame([(1, "of the")], "k int, text string"), "k")
    found = search.matched_regions(lines, ["of", "the"], "k", ["page_no"])
    assert [tuple(r) for r in found.collect()] == [(1, 1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(tokens" not in plan and plan.count("Generate") == 2  # lines, and one array of tokens for each
