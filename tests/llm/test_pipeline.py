"""The pipeline's stages, each on its own input, against plain versions."""

import re

import corpus_pipeline as cp
import pytest
from skyherald.llm import decontaminate, pii
from skyherald.llm.common import stored
from skyherald.llm.tokens import text_slices, window_hashes


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in cp.STAGES:
        out = stored(stage(spark, docs, sf), name)
        seen.append((name, docs, out))
        docs = out
    return {name: (before, after) for name, before, after in seen}


def test_stages_keep_the_columns(spark, sf, stages):
    columns = spark.read.parquet(f"{sf}/documents.parquet").dtypes
    for name, _ in cp.STAGES[:-1]:
        assert stages[name][1].dtypes == columns
    assert cp.run(spark, sf).count() == stages["packing"][1].count()


def test_quality_stage_keeps_clean_documents(spark, sf, stages):
    kept = {r.doc_id for r in stages["quality_rules"][1].collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    texts = {r.doc_id: r.text for r in stages["quality_rules"][0].collect()}
    good = [r.doc_id for r in labels if r.quality == 1 and len(texts[r.doc_id].split()) >= 80]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_dedup_stage_leaves_one_of_each_group(stages):
    before, after = (df.select("doc_id", "text").toArrow() for df in stages["simhash_dedup"])
    kept = set(after.column("doc_id").to_pylist())
    ids, sets = before.column("doc_id").to_pylist(), []
    for lo, hi, w in text_slices(before.column("text")):
        grams = window_hashes(w.hashes(), 5)
        sets += [frozenset(grams[w.first[r] : max(w.first[r], w.first[r + 1] - 4)].tolist()) for r in range(hi - lo)]
    near, left, lone = 0, 0, 0
    for i in range(len(ids)):
        best = 0.0
        for j in range(len(ids)):
            if i != j and (both := len(sets[i] & sets[j])):
                similarity = both / len(sets[i] | sets[j])
                best = max(best, similarity)
                if j < i and similarity >= 0.8:
                    near += 1
                    left += ids[i] in kept and ids[j] in kept
        lone += best < 0.5 and ids[i] not in kept
    assert near and left <= max(1, 0.05 * near)
    assert lone == 0


def test_decontamination_stage(spark, sf, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    block = decontaminate.Block(items, decontaminate.ERROR_RATE)
    plain = [decontaminate.normal(t) for _, t in items]
    kept = {r.doc_id for r in after.collect()}
    for r in before.collect():
        text = decontaminate.normal(r.text)
        if any(p in text for p in plain):
            assert r.doc_id not in kept
        assert (r.doc_id in kept) == (not block.search(text))


def test_redaction_stage(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages["pii_redaction"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        assert not pii.spans_of(r.text)[0]
        if not pii.spans_of(before[i].text)[1]:
            assert r.text == before[i].text
        assert len(re.findall(r"\[EMAIL\]", r.text)) == sum(s["kind"] == 0 for s in pii.spans_of(before[i].text)[0])


def test_packing_stage_places_every_word(stages):
    before, after = stages["packing"]
    words = {r.doc_id: len(r.text.encode().split()) for r in before.collect()}
    placed = {}
    for r in after.collect():
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
    assert placed == words


def test_python_stages_get_small_batches(spark, tmp_path, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.range(3000).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 800) as text").coalesce(1).write.parquet(f"{tmp_path}/docs")
    spark.createDataFrame([(1, "no document holds this sentence")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sizes = f"{tmp_path}/sizes"

    def noted(run):
        def noting(batches):
            def each():
                for batch in batches:
                    with open(sizes, "a") as f:
                        f.write(f"{batch.nbytes}\n")
                    yield batch

            return run(each())

        return noting

    scan = decontaminate._scan
    monkeypatch.setattr(decontaminate, "_scan", lambda *a: noted(scan(*a)))
    monkeypatch.setattr(pii, "_find", noted(pii._find))
    docs = spark.read.parquet(f"{tmp_path}/docs")
    spark.conf.unset(key)
    try:
        for stage in (cp.decontamination, cp.pii_redaction):
            spark.conf.unset(key)
            assert stage(spark, docs, str(tmp_path)).count() == 3000
    finally:
        spark.conf.set(key, before)
    found = [int(x) for x in open(sizes)]
    # a batch may pass the bound by a row; text and row are both in it
    assert found and max(found) < 2 * (4 << 20)
