import public_tokenizers

from __spark_entry__ import oracle_sql, queries
from checks.compare import connect, differences
from tablelift.llm import packing, pieces
from tablelift.llm import pipeline as corpus_pipeline
from tablelift.llm.common import tidy
from tablelift.llm.queries import QUERIES, TWINS
from tests.llm.conftest import prose
from tests.llm.test_exact import _wanted
from tests.llm.test_jaccard import _brute

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_queries_are_registered():
    assert [k for k in queries() if k.startswith("op")] == [k for k in QUERIES if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")) == list(range(1, 14))
    assert TWINS.items() <= oracle_sql().items()


def test_twins(spark):
    con = connect(SF)
    for name in ("op3_chat_format", "op10_exact_dedup"):  # the others stand beside their operators' tests
        assert differences(QUERIES[name](spark, SF), con, TWINS[name]) == [], name


def test_the_root_module_is_this_pipeline():
    import corpus_pipeline as root

    assert [n for n, _ in root.STAGES] == ["toxicity", "quality_rules", "exact_dedup", "ngram_jaccard", "packing"] and root.ORACLE_SQL is None and callable(root.run)


def test_columns_of_any_name_come_through(spark):
    """Columns called like those that stages use inside, and repeated ids."""
    near = prose(9, 150)
    rows = [(1, near, "a", 1, 7, "x", 2), (1, near + " more", "b", 2, 7, "y", 3), (2, "Copy here", "c", 3, 7, "z", 4), (3, "copy here", "d", 4, 7, "z", 5), (3, "copy here", "e", 5, 7, "z", 6), (None, None, "f", 6, 7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_sha256 string, _key long, word int, _row string, _word long")
    left = corpus_pipeline.drop_copies(spark, docs, SF)
    assert left.columns == docs.columns and sorted(r.text_sha256 for r in left.collect()) in (["a", "b", "d", "f"], ["a", "b", "e", "f"])
    left = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r._key in (1, 2, 3, 4, 5, 6)) for r in left.collect()) == [(0, True), (1, True), (2, True)]
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_poor):
        assert stage(spark, docs, SF).columns == docs.columns
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, SF).collect()} == {1, 2, 3, None}


def test_only_rows_that_may_go_are_moved(spark, tmp_path):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    gone = docs.where("doc_id % 50 = 7").select("doc_id")
    maybe, others = corpus_pipeline._sieved(docs, gone, {"doc_id": docs["doc_id"]})
    assert maybe.count() < 1000 and maybe.count() + others.count() == 5000 and others.join(gone, "doc_id").count() == 0
    left = corpus_pipeline._without(docs, gone, {"doc_id": docs["doc_id"]})
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(5000) if i % 50 != 7]


def test_all_stages_on_given_documents(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in rows}
    assert 0 < len(ids) < 200 and all(sum(r.length for r in rows if r.doc_id == i) == next(r.doc_tokens for r in rows if r.doc_id == i) for i in ids)


def test_copies_and_near_copies_leave_one(spark):
    near = prose(5, 200)
    rows = [(1, "Same text"), (2, "same TEXT"), (3, near), (4, near + " more"), (5, near + " and"), (None, "same text"), (6, None), (7, ""), (8, "own words here"), (8, "own words here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
    left = corpus_pipeline.drop_copies(spark, docs, SF)
    keep = {x[0] for x in _wanted(rows) if x[3]}
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(keep) == [2, 3, 4, 5, 7, 8]
    left = corpus_pipeline.drop_near_copies(spark, docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), SF)
    assert {r.doc_id for r in left.collect()} == {x[0] for x in _brute([r for r in rows if r[0] is not None]) if x[0] == x[2]}


def test_rows_of_one_id_go_or_stay_with_their_own_text(spark):
    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)

    copies = [(None, "A"), (None, "B"), (None, "b"), (1, "a"), (4, "c"), (4, "d"), (5, "C"), (6, None), (6, "e"), (7, ""), (8, "f"), (8, "f"), (8, "g")]
    got = left(corpus_pipeline.drop_copies, copies)
    assert [(i, (t or "").lower()) for i, t in got] == [(1, "a"), (4, "d"), (5, "c"), (6, "e"), (7, ""), (8, "f"), (8, "g"), (None, "b")]

    a, b, c, d = (prose(k, 200) for k in range(20, 24))
    near = [(1, a), (1, b), (2, a + " more"), (2, c), (0, b + " more"), (3, d), (4, d + " and"), (None, a), (None, c), (None, c)]
    kept = [(0, b + " more"), (1, a), (2, c), (3, d), (None, a), (None, c), (None, c)]
    assert left(corpus_pipeline.drop_near_copies, near) == sorted(kept, key=repr)
    once = [(1, a), (2, a + " more"), (None, b), (None, a)]
    assert left(corpus_pipeline.drop_near_copies, once) == sorted([(1, a), (None, a), (None, b)], key=repr)


def test_filters_keep_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == DOCUMENTS.replace(",", "").split()[::2] and docs.count() == 0
    assert corpus_pipeline.pack(spark, docs, SF).count() == 0


def test_a_task_of_another_stage_drops_what_the_packer_keeps_in_its_worker():
    path = public_tokenizers.path("word_bpe_49k.json")
    packing._worker(path)
    same = lambda batches: batches
    assert list(tidy(same, keeps=True)(iter([]))) == []
    assert packing._worker.cache_info().currsize == pieces.load.cache_info().currsize == 1
    assert list(tidy(same)(iter([1]))) == [1]
    assert packing._worker.cache_info().currsize == pieces.load.cache_info().currsize == 0
