"""Every operator on odd rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickguard.llm import decontam, jaccard, lexical, lm, negatives, packing, pii, quality, sharding, simhash, substring, toxicity, urlfilter
from tickguard.llm.queries import QUERIES, word_bpe


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1), (1, 0), (3, 0), (5, 1), (7, None), (None, 1), (5, 0)],
                                 "doc_id long, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame([(1, "same TEXT here"), (2, None), (3, ""), (4, "twice"), (None, "word")],
                                 "item_id long, text string")


OPERATORS = {
    "pii": lambda d, labels, items: pii.find(d),
    "toxicity": lambda d, labels, items: toxicity.scored(d, labels),
    "substring": lambda d, labels, items: substring.repeats(d),
    "quality": lambda d, labels, items: quality.judge(d),
    "simhash": lambda d, labels, items: simhash.near_groups(d),
    "sharding": lambda d, labels, items: sharding.shard(d, 8),
    "decontam": lambda d, labels, items: decontam.find(d, items),
    "lm": lambda d, labels, items: lm.score(d),
    "jaccard": lambda d, labels, items: jaccard.similar_groups(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(odd, none, labels, items, name):
    run = OPERATORS[name]
    made = run(odd, labels, items)
    assert made.count() == odd.count()
    assert run(none, labels, items).count() == 0
    if name in ("pii", "toxicity", "sharding", "decontam"):
        assert set(odd.columns) <= set(made.columns)
        assert made.filter("score = 'x'").count() == odd.count()


def test_packing_gives_every_row_a_piece(odd, none):
    made = packing.pack(odd, word_bpe())
    assert made.filter("start = 0").count() == odd.count()
    assert made.filter("doc_id in (0, 1, 2)").select("length", "doc_tokens").distinct().collect() == [(1, 1)]
    assert packing.pack(none, word_bpe()).count() == 0


def test_defined_values_of_empty_texts(odd, labels, items):
    empty = "doc_id in (0, 1, 2)"
    assert {tuple(r) for r in simhash.near_groups(odd).filter(empty).select("fp", "component_id").collect()} == {(0, 0)}
    assert {tuple(r) for r in quality.judge(odd).filter(empty).select("n_words", "base_failed", "kept").collect()} == {
        (0, True, False)}
    assert {tuple(r) for r in decontam.find(odd, items).filter(empty).select(
        "_n_words", "_n_hit", F.size("_items")).collect()} == {(0, 0, 0)}
    assert {r.n_tokens for r in lm.score(odd).filter(empty).collect()} == {1}
    assert {r[0] for r in pii.find(odd).filter(empty).select(F.size("_spans")).collect()} == {0}


def test_items_without_an_id_have_hits_but_no_name(spark, odd, items):
    found = decontam.find(odd, items).filter("text = 'word'").select("_n_hit", "_items").distinct().collect()
    assert [tuple(r) for r in found] == [(1, [])]


def test_jaccard_groups_of_odd_rows(odd):
    made = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.similar_groups(odd).collect()}
    assert (made[0, 0], made[1, 0], made[2, 0], made[None, 0]) == (0, 1, 2, None)
    assert (made[3, 1], made[5, 1], made[6, 1], made[9, 1], made[10, 1], made[None, 1]) == (3, 5, 5, 9, 9, None)
    assert made[11, 10] == 11


def test_lexical_search_over_odd_rows(odd, none, items):
    made = lexical.rank(odd, items).collect()
    assert {r.item_id for r in made} == {1, 4, None}
    words = [(r.rank, r.doc_id) for r in made if r.item_id is None]
    assert sorted(words) == [(1, 3), (2, 3), (3, 3)]                         # a row three times
    assert {r.doc_id for r in made if r.item_id == 4} == {5, 6}
    assert lexical.rank(none, items).count() == 0 == lexical.rank(odd, items.limit(0)).count()


def test_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(
        [None, "", "no scheme", "http://", "HTTP://A.B.NET", "x://u@WWW.Bad.org:80/p/?q", "y://bad.org/p"])],
        "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS key", "'z' AS rule", "'w' AS path")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([("www.bad.org", "/p"), ("www.bad.org", "/p")], "host string, path string")
    made = urlfilter.filter_urls(pages, rules, listed).orderBy("page_id").collect()
    assert [(r._host, r._path, r._rule, r._verdict) for r in made] == [
        ("", "", None, "allow")] * 4 + [("a.b.net", "", None, "allow"),
        ("u@www.bad.org:80", "/p/", None, "block"), ("bad.org", "/p", None, "block")]
    assert {r.host for r in made} == {"x"}
    assert {r._verdict for r in urlfilter.filter_urls(pages, rules.limit(0), listed.limit(0)).collect()} == {"allow"}
    assert urlfilter.filter_urls(pages.limit(0), rules, listed).count() == 0


def test_stages_keep_the_columns(spark, odd, none, items, labels, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, str(tmp_path))
            assert set(made.columns) == set(docs.columns)
            assert made.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).filter("start = 0").count() == docs.count()


def test_toxicity_query_gives_python_workers_few_bytes_at_once(spark, sf):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    QUERIES["op2_toxicity"](spark, sf)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20


def test_packing_keeps_stretches_and_their_words_in_one_bounded_cache(spark):
    made = packing.Encoder(word_bpe(), 40)
    for i in range(5):
        texts = [f"one{'abcde'[i]}{c}, two!! {c}x 12{c} ..." for c in "abcdefgh"] + ["", "\u2003 ß% %"]
        want = [made.tokenizer.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]
        assert [list(memoryview(ids).cast("I")) for ids in made(texts)] == want
        assert b"two" in made.known
