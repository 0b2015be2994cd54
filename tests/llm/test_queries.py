import re

import __spark_entry__
import corpus_pipeline
from quillgraph.llm import packing, toxicity

from .helpers import docs, labels
from .test_packing import check
from .test_simhash import brute_prints, components
from .test_toxicity import corpus


def test_every_operator_has_one_query():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_pipeline_agrees_with_its_parts(spark, tmp_path):
    texts, toxic = corpus(200, 4)
    texts += [texts[1], texts[2].upper(), None, "", "!!! $$$ %%%"]
    toxic += [0] * 5
    df = docs(spark, texts)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    lab = labels(spark, [(i, int(i % 7 > 0), t) for i, t in enumerate(toxic)])
    lab.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    model = toxicity.fit_toxicity(df, lab, "doc_id", "text")
    score = model.scorer()
    clean = {i: brute_prints(t, 5) for i, t in enumerate(texts) if score(t)[0] < 0.2}
    assert {r.doc_id for r in out} == set(components(clean, 4).values())
    assert check([(r.length, r.sequence_id, r.offset) for r in out], packing.SIZE) == -(-sum(r.length for r in out) // packing.SIZE)
    assert 0 not in {r.doc_id for r in out} and 201 not in {r.doc_id for r in out}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).columns == df.columns
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
