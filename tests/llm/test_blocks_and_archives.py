"""Benchmarks of many blocks, short items, archives over several tasks, texts without letters."""

import random

import pytest
from pyspark.sql import functions as F

from skyherald.llm import decontaminate, language, warc

DOCS = "doc_id long, text string"


def test_many_blocks_find_what_one_does(spark):
    rng = random.Random(4)
    items = [(i, "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(15, 40)))) for i in range(40)]
    items += [(40, items[3][1]), (3, items[3][1]), (50, "yes"), (51, None)]
    rows = [(0, None), (1, ""), (2, "oh, yes"), (3, "eyes"), *[(4, items[3][1])] * 3]
    rows += [(10 + i, f"{rng.choice(items[:40])[1]} and {rng.choice(items[:40])[1].replace('a', 'x', 1)}") for i in range(30)]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items if t)

    def found(block_chars):
        got = decontaminate.find_contamination(docs, bench, error_rate=0.1, block_chars=block_chars).collect()
        return sorted((r.doc_id, r.text or "", r.contaminated, sorted(map(tuple, r.matches))) for r in got)

    one = found(1_000_000)
    assert len(one) == len(rows) and found(size // 10) == one  # 20 blocks
    assert {d for d, _, c, _ in one if c} >= {2, 4} and not {d for d, _, c, _ in one if c} & {0, 1, 3}
    assert [len(m) for d, _, _, m in one if d == 4] == [3, 3, 3]  # equal items each count


def test_short_items_are_whole_words(spark):
    docs = spark.createDataFrame([(1, "bayesian thing"), (2, "Is it a thing?"), (3, "eyes"), (4, "Yes"), (5, "no, yes!")], DOCS)
    bench = spark.createDataFrame([("x", "a"), ("y", "Yes")], "item_id string, text string")
    got = {r.doc_id: [(m.item_id, m.start, m.end) for m in r.matches] for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got == {1: [], 2: [("x", 6, 7)], 3: [], 4: [("y", 0, 3)], 5: [("y", 3, 6)]}


@pytest.mark.parametrize("block_chars", [2, 1_000_000])
def test_dropping_over_empty_tables_and_clashing_names(spark, block_chars):
    kind = "doc_id long, text string, matches string, digest string, contaminated int, row long"
    docs = spark.createDataFrame([(1, "a benchmark item of some length", "m", "d", 7, 8), (2, "clean", None, None, None, None)], kind)
    bench = spark.createDataFrame([(1, "benchmark item"), (2, "another one")], "item_id long, text string")
    drop = decontaminate.drop_contaminated
    assert [tuple(r) for r in drop(docs, bench, block_chars=block_chars).collect()] == [(2, "clean", None, None, None, None)]
    assert drop(docs.limit(0), bench, block_chars=block_chars).collect() == []
    assert drop(docs, bench.limit(0), block_chars=block_chars).count() == 2
    assert drop(docs, bench, block_chars=block_chars).schema == docs.schema


def test_archives_are_spread_over_tasks(spark):
    kind = "page_id long, url string, html string, archive string, offset long, record_id long"
    pages = spark.createDataFrame([(i, f"u{i}", chr(97 + i % 26) * 3000, "x", -1, 5) for i in range(60)], kind).repartition(4)
    folder = warc.shared_dir(spark, "test-archives")
    listed = warc.write_archives(warc.plan_records(pages, "page_id", "html", "url", 1000), f"{folder}/whole", 4000)
    count = listed.count()
    assert count >= 8
    index = warc.normalise(listed, f"{folder}/records")
    assert len(index.inputFiles()) > count // 2  # as many tasks as archives, merged by nothing
    read = warc.read_records(index).select("record_id", F.spark_partition_id().alias("task")).collect()
    assert len(read) == 60 and len({r.task for r in read}) > 4
    got = warc.archived(pages)
    assert got.count() == 60 and got.filter("record_type = 'revisit'").count() == 34
    assert warc._tasks(listed, 0) == 1 and warc._tasks(listed, 10**6) == 62_500


def test_marks_alone_are_no_language(spark):
    docs = spark.createDataFrame(
        [(1, "the house"), (2, "́̂ ̀"), (3, "12 !"), (4, None), (5, "́ the é"), (6, "́the ́")], DOCS)
    model = language.learn(docs.filter("doc_id = 1").withColumn("lang", F.lit("en")))
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in language.identify(docs, model).collect()}
    assert got == {1: ("en", True), 2: ("und", False), 3: ("und", False), 4: ("und", False), 5: ("en", True), 6: ("en", True)}
