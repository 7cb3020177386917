import pytest

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        path + "/labels.parquet")
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")],
                          "item_id long, text string").write.parquet(path + "/benchmark.parquet")
    return path


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def test_stages_take_odd_rows(spark, folder, odd_rows):
    for name, stage in P.STAGES:
        for rows in (odd_rows, []):
            out = stage(spark, docs(spark, rows), folder)
            assert name == "packing" or out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            out.collect()


def test_line_stage(spark, folder):
    rows = [(i, f"shared line\nown {i}") for i in range(12)] + [(50, "shared line"), (51, "x\n\nshared LINE "), (52, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in P.drop_repeated_lines(spark, docs(spark, rows), folder).collect()}
    assert got[0] == ("shared line\nown 0", 17) and got[3] == ("own 3", 5)
    assert 50 not in got and got[51] == ("x\n", 2) and got[52][0] == ""


def test_long_lines_need_two_documents(spark, folder):
    """51 words in two documents are a repeated passage, 50 are not."""
    passage, short = " ".join(["so"] * 51), " ".join(["well"] * 50)
    rows = [(i, f"own {i}\n{passage}\n{short}") for i in range(2)] + [(2, f"\t{passage.upper()} \nend {short}")]
    got = {r.doc_id: r.text for r in P.drop_repeated_lines(spark, docs(spark, rows), folder).collect()}
    assert got == {0: rows[0][1], 1: f"own 1\n{short}", 2: f"end {short}"}


def test_near_duplicate_stage(spark, folder):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, text + " more"), (2, text + " more"), (3, ""), (3, ""), (4, "other words"), (5, text), (1, text)]
    got = sorted((r.doc_id, r.text) for r in P.drop_near_duplicates(spark, docs(spark, rows), folder).collect())
    assert got == [(1, text), (3, ""), (3, ""), (4, "other words")]


def test_unlinked_texts_under_one_id_stay(spark, folder):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, b), (None, c), (None, d), (None, c), (None, ""), (None, ""), (7, d)]
    got = sorted(((r.doc_id, r.text) for r in P.drop_near_duplicates(spark, docs(spark, rows), folder).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), (7, d), (None, ""), (None, "")], key=str)


def test_contamination_stage(spark, folder):
    rows = [(1, "so alpha beta gamma delta epsilon zeta ETA theta, iota kappa it is"), (2, "alpha beta gamma"), (3, None)]
    got = sorted(r.doc_id for r in P.drop_contaminated(spark, docs(spark, rows), folder).collect())
    assert got == [2, 3]


def test_run_equals_its_stages(spark):
    got = P.run(spark, "/root/testdata/sf0.001")
    tables = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    step = tables
    sizes = [step.count()]
    for _, stage in P.STAGES[:-1]:
        step = stage(spark, step, "/root/testdata/sf0.001").cache()
        sizes.append(step.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {r.doc_id for r in step.collect()}
