"""The pipeline against its stages in plain Python, and each stage's columns."""

import brute

import corpus_pipeline
from chorale.llm import quality
from chorale.session import materialise


def test_run_equals_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    # The trees are the one part that is taken over; the base rules are not.
    good = {r["doc_id"] for r in quality.judge(docs, labels).filter("quality_score >= 0").collect()}
    left = [r[0] for r in brute.op5([(d, t) for d, (t, _) in texts.items()]) if not r[-1] and r[0] in good]
    left = [r[0] for r in brute.op6([(d, texts[d][0]) for d in left]) if r[3]]
    left = [d for d, _, c in brute.components([(d, texts[d][0]) for d in left], 5, 80) if d == c]
    want = brute.targets([(d, *texts[d]) for d in left])

    stages, seen = dict(corpus_pipeline.STAGES), docs
    assert list(stages) == ["quality_rules", "exact_dedup", "ngram_jaccard", "mixing", "sentencepiece"]
    for name in list(stages)[:4]:
        seen = materialise(stages[name](spark, seen, sf), name)
        assert seen.columns == docs.columns
        if name == "ngram_jaccard":
            assert sorted(r["doc_id"] for r in seen.collect()) == sorted(left)
    mixed = [r["doc_id"] for r in seen.collect()]
    taken = {}
    for d in mixed:
        text, source = texts[d]
        taken[source] = taken.get(source, 0) + len(brute.WORD.findall(text))
    for source, (size, target) in want.items():
        own = [len(brute.WORD.findall(texts[d][0])) for d in left if texts[d][1] == source]
        rounds, sums = int(target) // size, {0}
        for n in own:
            sums |= {s + n for s in sums}
        assert taken.get(source, 0) == rounds * size + max(s for s in sums if s <= int(target) - rounds * size)
    assert all(mixed.count(d) <= 2 for d in set(mixed)) and set(mixed) <= set(left)

    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(tuple, out)) == sorted(brute.op8([(d, texts[d][0]) for d in mixed]))


def test_stages_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
