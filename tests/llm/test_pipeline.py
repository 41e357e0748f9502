"""The pipeline's rows against a plain version of each stage."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from test_parts import plain_classes

import corpus_pipeline
from textmill.llm import decontaminate, mixing, pii, toxicity
from textmill.llm.arrow import flat
from textmill.llm.sampling import remainder

FOLDER = "/root/testdata/sf0.001"


def test_run_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(remainder(F.col("doc_id"), 3) != 1)
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    score = {k: model.score(*flat(pa.array([r.text])))[0] for k, r in rows.items()}
    kept = {k for k in rows if score[k] < 0.7}
    groups = plain_classes([(k, rows[k].text) for k in kept])
    kept = {k for k in kept if groups[k][0] == k}
    items = [r.text.strip() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {k for k in kept if not any(decontaminate.distance(rows[k].text, t, int(len(t) * decontaminate.MAX_SHARE)) for t in items)}
    left = docs.where(F.col("doc_id").isin(*kept))
    field = pii.fit(left)
    texts = {k: pii.mask(rows[k].text, [s for part in pii.find(rows[k].text, field) for s in part]) for k in kept}
    n = Counter(rows[k].source for k in kept)
    weight = sum(x**0.5 for x in n.values())
    want = Counter()
    for k in kept:
        source = rows[k].source
        rate = len(kept) * n[source] ** 0.5 / weight / n[source]
        low, cdf = mixing.poisson_table(rate)
        u = int(hashlib.md5(f"mix:{k}".encode()).hexdigest()[:13], 16) / 2**52
        for copy in range(1, low + int(np.searchsorted(cdf, u, "right")) + 1):
            want[(k, texts[k], len(texts[k]), copy)] += 1
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.text, r.n_chars, r["copy"]) for r in got) == want
    assert len(got) > 100
