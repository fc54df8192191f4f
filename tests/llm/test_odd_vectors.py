"""Near-duplicate and nearest vectors of several lengths and of very large or small components."""

from clientele.llm import multi_index, tree_forest


def found(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {r.vec_id: (r.n_links, r.component_id) for r in tree_forest.near_duplicates(table).collect()}


def test_each_length_links_within_itself(spark):
    rows = [(i, [float(i % 5 == k) for k in range(4)]) for i in range(20)]
    rows += [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [1.0, 2.1]), (103, [-2.0, 1.0]), (104, [5.0]), (105, [3.0]), (106, [-1.0])]
    got = found(spark, rows)
    assert got[100] == got[101] == got[102] == (2, 100) and got[103] == (0, 103)
    assert got[104] == got[105] == (1, 104) and got[106] == (0, 106)
    assert got[0] == (3, 0) and got[4] == (0, 4)


def test_large_and_small_components(spark):
    rows = [(1, [1e200, 1e200, 0.0, 0.0]), (2, [1e200, 1.0001e200, 0.0, 0.0]), (3, [1e-200, 1e-200, 0.0, 0.0]), (4, [5e-324, 0.0, 0.0, 0.0]),
            (5, [1.7e308, 0.0, 0.0, 1.0]), (6, [0.0, 0.0, 3.0, 4.0]), (7, None), (8, [0.0] * 4), (9, [1.0, None, 0.0, 0.0])]
    got = found(spark, rows)
    assert got[1] == got[2] == got[3] == (2, 1) and got[4] == got[5] == (1, 4)
    assert all(got[i] == (0, i) for i in (6, 7, 8, 9))


def nearest(spark, rows, **options):
    out = {}
    for r in multi_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), **options).collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {q: [hits[i] for i in sorted(hits)] for q, hits in out.items()}


def test_each_length_is_searched_by_itself(spark):
    rows = [(i, [float(i), 1.0, -2.0], "x") for i in range(1, 31)] + [(40, [1.0, 3.0], None), (41, [2.0, 2.0], None), (42, [-1.0, 0.0], None),
                                                                    (60, [5.0], "y"), (61, [2.0] * 4, "y")]
    got = nearest(spark, rows)
    assert [h[0] for h in got[20]] == [i for i in range(30, 0, -1) if i != 20][:20]
    assert got[40] == [(41, 8.0), (42, -1.0)]  # fewer candidates than 20: all of them
    assert set(got) == {20, 40}  # the only vector of its length finds none


def test_odd_queries_and_candidates(spark):
    rows = [(20, [1.0, 0.0], "a"), (20, [1.0, 0.0], "b"), (None, [9.0, 9.0], "c"), (1, [2.0, 0.0], "d"), (1, [2.0, 0.0], "d"), (0, [0.0, 0.0], "z"),
            (2, [2.0, 5.0], "e"), (3, None, "f"), (4, [float("nan"), 1.0], "g"), (5, [float("inf"), 1.0], "h"), (6, [None, 1.0], "i"), (7, [], "j"),
            (8, [1e300, 1e300], "k"), (9, [5e-324, 0.0], "l"), (40, [1e300, -1e300], "m")]
    got = nearest(spark, rows)
    assert got[20] == [(8, 1e300), (40, 1e300), (1, 2.0), (1, 2.0), (2, 2.0), (9, 5e-324)]
    # 1e300 times 1e300 is infinite, and the difference of two such products is no number: it comes last
    assert [h[0] for h in got[40]] == [1, 1, 20, 20, 9, 2, 8]
    assert set(got) == {20, 40}
