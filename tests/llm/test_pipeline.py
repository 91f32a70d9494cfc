import corpus_pipeline as C

from churnlab.llm import exact_dedup, near_dedup, quality

from .helpers import SF, docs_frame, rows_of


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet").cache()
    seen = {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen[name] = docs
        if name != C.STAGES[-1][0]:
            assert docs.columns == first.columns
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(seen["quality_rules"]) == ids(quality.quality_verdicts(first, labels).filter("kept"))
    assert ids(seen["exact_dedup"]) == ids(exact_dedup.duplicate_groups(seen["quality_rules"]).filter("kept"))
    assert ids(seen["near_dedup"]) == ids(near_dedup.near_duplicate_components(seen["exact_dedup"], percent=C.NEAR_PERCENT).filter("kept"))
    assert seen["pii"].join(seen["near_dedup"].withColumnRenamed("text", "before"), "doc_id").filter("text <> before").count() > 0
    assert ids(seen["packing"]) == ids(seen["pii"])


def test_registered():
    from __spark_entry__ import queries
    names = set(queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{k}" for k in range(1, 14)}


LONG = " ".join(f"word{k}" for k in range(100))
NEAR = " ".join(f"word{k}" for k in range(99)) + " other"


def test_rows_of_one_id_with_two_texts_are_told_apart(spark):
    docs = docs_frame(spark, [(3, "bb"), (5, "aaaa only here"), (5, "bb"), (7, "same"), (7, "same"), (None, "same"), (8, None), (8, ""), (None, "alone"),
                              (None, "alone")])
    left = rows_of(exact_dedup.drop_exact_duplicates(docs), "doc_id", "text")
    empty = [r for r in left if r[0] == 8]   # a null and an empty text are equal
    assert len(empty) == 1 and not empty[0][1]
    assert [r for r in left if r[0] != 8] == sorted([(3, "bb"), (5, "aaaa only here"), (7, "same"), (None, "alone")], key=repr)
    docs = docs_frame(spark, [(9, LONG), (4, NEAR), (4, "alone under this id but not alone in it"), (None, LONG), (11, None), (12, ""), (2, "few words"), (2, "few words")])
    assert rows_of(near_dedup.drop_near_duplicates(docs, percent=80), "doc_id", "text") == sorted(
        [(4, NEAR), (4, "alone under this id but not alone in it"), (None, LONG), (11, None), (12, ""), (2, "few words")], key=repr)


def test_columns_with_the_names_used_inside(spark):
    docs = docs_frame(spark, [(1, LONG), (2, NEAR), (3, LONG), (4, "z")], extra=True)
    for c in ("_dropped", "_ROW", "_row_", "_best", "component_id", "kept", "a", "b", "id", "_at"):
        docs = docs if c.lower() in map(str.lower, docs.columns) else docs.selectExpr("*", f"'x' as `{c}`")
    for f, want in ((exact_dedup.drop_exact_duplicates, {1, 2, 4}), (near_dedup.drop_near_duplicates, {1, 4})):
        got = f(docs)
        assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == want


def test_whole_pipeline_on_odd_rows_and_an_empty_table(spark, tmp_path):
    good = "The committee met on Monday to agree the plan for the new year. " * 6
    rows = [(1, good), (1, good + "More."), (2, good), (2, good), (None, good), (3, None), (4, ""), (5, "x" * 50_000), (6, good.upper())]
    for name, data in (("odd", rows), ("none", [])):
        path = str(tmp_path / name)
        docs_frame(spark, data, extra=True).write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
        got = C.run(spark, path).collect()
        assert {r["doc_id"] for r in got} <= {r[0] for r in data}
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for stage, f in C.STAGES[:-1]:
            docs = f(spark, docs, path)
            assert docs.columns == spark.read.parquet(f"{path}/documents.parquet").columns, stage
