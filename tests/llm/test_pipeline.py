"""Each pipeline stage against a brute-force version on its own input."""

from collections import defaultdict

import corpus_pipeline
from rivulet.llm._common import BATCH, BATCH_BYTES
from test_operators import alnum, brute_contamination, brute_near, library_ids


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf).write.parquet(str(tmp_path / str(number)))
        tables.append(spark.read.parquet(str(tmp_path / str(number))))
    assert all(t.columns == columns for t in tables[:-1])
    assert tables[-1].columns == [*columns, "input_ids"]
    texts = [{r.doc_id: r.text for r in t.select("doc_id", "text").collect()} for t in tables]

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum((d in texts[1]) == bool(q) for d, q in labels.items()) >= 0.95 * len(labels)

    near = brute_near(list(texts[1].items()), 5, 80)
    assert set(texts[2]) == {d for d, (n, _, kept) in near.items() if kept or not n}

    where = defaultdict(set)
    for d, t in texts[3].items():
        w = alnum(t)
        for j in range(len(w) - 49):
            where[tuple(w[j : j + 50])].add(d)
    assert not [d for d in where.values() if len(d) > 1 and len(set(next(k for k, v in where.items() if v is d))) > 10]
    assert set(texts[3]) <= set(texts[2])

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = brute_contamination(list(texts[3].items()), items)
    assert set(texts[4]) == {d for d, v in found.items() if not v[4]}

    last = tables[-1].collect()
    assert [list(r.input_ids) for r in last] == library_ids([r.text for r in last])


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_stages_bound_the_batches_of_their_tasks(spark, sf):
    before = spark.conf.get(BATCH, None)
    try:
        for own, wanted in ((None, BATCH_BYTES), ("12345", 12345)):
            spark.conf.unset(BATCH) if own is None else spark.conf.set(BATCH, own)
            for _, stage in corpus_pipeline.STAGES[-1:]:
                stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
            assert int(spark.conf.get(BATCH)) == wanted
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)
