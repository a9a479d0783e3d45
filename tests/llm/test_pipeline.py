"""The pipeline against brute-force versions of its stages."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
from llm.test_packing import check_places, first_fit, slow_pieces
from llm.test_quality import slow_verdicts
from llm.test_secrets import slow_clean, slow_spans
from llm.test_simhash import slow_print, slow_sets
from tokenizers import Tokenizer

from barloom.llm import quality


def test_stages(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [tuple(r) for r in source]
    rows += [(5000, None, None, None, 0), (5001, "", "en", "src0", 0), (None, rows[1][1], "en", "src0", 1), rows[2], (5002, "12 34 5! " * 60, "en", "src0", 1)]
    rows += [(5003 + i, rows[4][1] + f"\ntoken = abcdefghijklmnop{i}", rows[4][2], rows[4][3], 9) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names, at = docs.columns, docs
    verdicts = slow_verdicts([((r[2], r[3]), r[1]) for r in rows], quality.LEAST_ROWS)
    want = [r for r, v in zip(rows, verdicts, strict=True) if v[-1]]
    kept = {}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        at = fn(spark, at, str(tmp_path))
        assert at.columns == names
        path = f"{tmp_path}/{name}"
        at.write.parquet(path)
        at = spark.read.parquet(path)
        kept[name] = [tuple(r) for r in at.collect()]
    assert sorted(kept["quality_rules"], key=repr) == sorted(want, key=repr)
    lettered = [r for r in want if any(c.isalpha() for c in r[1])]
    assert len(kept["language_id"]) >= 0.98 * len(lettered) and set(kept["language_id"]) <= set(lettered)
    prints = {r[1]: slow_print(r[1]) for r in kept["language_id"]}
    sets = slow_sets(prints.values())
    groups = {}
    for r in kept["language_id"]:
        groups.setdefault(sets[prints[r[1]]], []).append(r)
    first = [min(g, key=lambda r: (r[0] is None, r[0] or 0, prints[r[1]] - (prints[r[1]] >> 63 << 64), r[1])) for g in groups.values()]
    assert sorted(kept["near_copies"], key=repr) == sorted(first, key=repr)
    clean = [(r[0], slow_clean(r[1]), r[2], r[3], len(slow_clean(r[1])) if slow_spans(r[1]) else r[4]) for r in first]
    assert sorted(kept["secret_scan"], key=repr) == sorted(clean, key=repr)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()
    fields = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in fields) for r in packed) == Counter((r[0], *p) for r in clean for p in slow_pieces(r[1], library))
    assert check_places(packed) <= first_fit([r["length"] for r in packed])


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 50


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
