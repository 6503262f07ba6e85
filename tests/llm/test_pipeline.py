import corpus_pipeline
from tests.llm import test_decontamination, test_line_dedup, test_packing, test_shingle_sets
from tractline.llm import packing

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture_rows():
    clean = [" ".join(f"{w}{i}" for w in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta")) for i in range(40)]
    texts = [f"{clean[i]}\nand a line of words that number {i} repeats\nunique tail {i} ends the text here" for i in range(30)]
    texts += [texts[3], texts[4], clean[35] + "\nend", clean[35] + "\nend", None, None, "", "stupid " + clean[36], clean[37] + " idiot"]
    texts += ["header words\n" + " ".join(f"leak{k}" for k in range(30)) + "\nfooter words", clean[38].upper()]
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def test_stages_against_plain_versions(spark, tmp_path):
    rows = fixture_rows()
    folder = str(tmp_path)
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    bench = [(1, " ".join(f"leak{k}" for k in range(25)))]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    # Labels learn on documents of their own, which are no part of the fixture's clean rows.
    extra = [(1000 + i, f"{'stupid' if i % 4 == 0 else 'idiot' if i % 4 == 1 else 'fine'} words{i} of{i} text{i}", "en", "x", 0) for i in range(400)]
    learn = spark.createDataFrame(rows + extra, COLUMNS)
    spark.createDataFrame([(r[0], int(i % 4 < 2)) for i, r in enumerate(extra)], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = stages["toxicity"](spark, learn, folder)
    kept = sorted(map(tuple, docs.filter("doc_id < 1000").collect()))
    assert docs.columns == learn.columns
    want = [r for r in rows if not r[1] or ("stupid" not in r[1] and "idiot" not in r[1])]
    assert kept == want

    docs = spark.createDataFrame(kept, COLUMNS)
    lines = stages["line_dedup"](spark, docs, folder)
    plain = test_line_dedup.plain([(r[0], r[1]) for r in kept])
    got = {r.doc_id: (r.text, r.n_chars) for r in lines.collect()}
    assert lines.columns == docs.columns
    assert got == {r[0]: (plain[r[0]][0], len(plain[r[0]][0]) if plain[r[0]][1] else r[4]) for r in kept}

    firsts = test_shingle_sets.plain_kept([(i, text) for i, (text, _) in sorted(got.items())])
    near = stages["near_dedup"](spark, lines, folder)
    assert {r.doc_id for r in near.collect()} == firsts and near.count() == len(firsts) and near.columns == docs.columns

    leaks = {x[0] for x in test_decontamination.plain([(i, got[i][0]) for i in firsts], bench)}
    left = stages["decontamination"](spark, near, folder)
    assert {r.doc_id for r in left.collect()} == firsts - leaks and leaks and left.columns == docs.columns

    packed = stages["packing"](spark, left, folder).collect()
    test_packing.check(packed, {i: (got[i][0], f"src{i % 3}") for i in firsts - leaks}, packing.CAPACITY)


def test_stages_on_no_rows_and_repeated_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    for rows, left in (([], 0), ([(1, "some words in a row here", "en", None, 5)] * 3 + [(None, None, None, None, None)], 2)):
        docs = spark.createDataFrame(rows, COLUMNS)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
        assert docs.count() == left


def test_run_over_the_whole_table(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "words", "bin", "offset"] and 0 < got.count() <= 200
