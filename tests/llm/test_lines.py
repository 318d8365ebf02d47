from millrace.llm import lines

ROWS = [
    (1, "menu\nfirst own line", "a", 9),
    (2, "menu\nsecond own line\n\n menu ", "a", 9),
    (3, "third\nmenu", "a", 9),
    (4, "fourth", "a", 9),
    (5, None, "a", 9),
    (6, "", "a", 9),
    (7, "menu", "b", 9),
    (8, "solo\nsolo", None, 9),
    (9, "solo", None, 9),
    (9, "solo", None, 9),
]


def test_boilerplate_goes_by_host(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, marks int")
    found = lines.drop_boilerplate(docs, ratio=0.4)
    assert set(found.columns) == {"doc_id", "text", "source", "marks", "n_lines", "n_dropped"}
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"], r["marks"]) for r in found.filter("text is not null").collect())
    assert got == [
        (1, "first own line", 2, 1, 9),
        (2, "second own line\n", 4, 2, 9),
        (3, "third", 2, 1, 9),
        (4, "fourth", 1, 0, 9),
        (6, "", 1, 0, 9),
        (7, "menu", 1, 0, 9),
        (8, "", 2, 2, 9),
        (9, "", 1, 1, 9),
        (9, "", 1, 1, 9),
    ]
    null = found.filter("text is null").first()
    assert (null["n_lines"], null["n_dropped"]) == (0, 0)


def test_ratio_is_exclusive_and_empty_table(spark):
    docs = spark.createDataFrame([(i, f"x\nown {i}" if i < 4 else f"own {i}", "a") for i in range(8)], "doc_id long, text string, source string")
    assert lines.drop_boilerplate(docs, ratio=0.5, min_pages=2).agg({"n_dropped": "sum"}).first()[0] == 0
    assert lines.drop_boilerplate(docs, ratio=0.49, min_pages=2).agg({"n_dropped": "sum"}).first()[0] == 4
    assert lines.drop_boilerplate(docs.limit(0)).collect() == []


def test_copies_of_a_page_count_once(spark):
    rows = [(i, "copied\nthrice", "a") for i in range(3)] + [(3, "menu\nthree", "a"), (4, "menu\nfour", "a"), (5, None, "a"), (6, None, "a")]
    found = lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), ratio=0.4)
    assert {r["doc_id"]: r["n_dropped"] for r in found.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0}
