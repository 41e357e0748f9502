"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores of the local session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from textmill import catalog
from textmill.session import local_session

HEADLINE = [
    "clean_text", "qa_block", "conversation_block", "source_cap", "char_budget", "saturating_budget", "build_mixture",
    "math_corpus", "knowledge_corpus", "science_corpus", "language_corpus", "conversation_corpus", "facts_corpus", "writing_corpus", "write_corpus", "corpus_size", "char_vocab", "char_encode", "pair_counts", "bpe_train", "bpe_train_large", "tokenise_report", "bpe_encode",
    "bpe_decode", "round_trip", "bpe_encode_large", "bpe_decode_large", "split_tokens", "pack_blocks", "sample_windows", "lm_fit", "lm_eval", "lm_next",
    "config_audit", "list_runs", "log_progress", "stream_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "textmill-bench")
    queries = catalog.queries()
    # One small query first, so that the start of the session is not counted.
    queries["corpus_size"](spark, folder).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "textmill_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
