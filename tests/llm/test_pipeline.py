import base64
import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from test_dedup import BLANK
from test_shingles import brute_kept
from test_text import brute_contamination, nulls_last, toxic_rows


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = toxic_rows(300)
    item = " ".join(f"bench{i}" for i in range(30))
    rows += [(1000 + i, rows[1 + i][1]) for i in range(3)]  # copies
    near = rows[2][1].split() * 8
    rows += [(1100, " ".join(near)), (1101, " ".join(near[:-1] + ["other"]))]
    rows += [(1200, f"{rows[3][1]} {item}"), (1201, None), (1202, ""), (1203, rows[6][1] + "  \n")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        after = stage(spark, kept, str(tmp_path))
        ids = {r["doc_id"] for r in after.collect()}
        if name != "byte_bpe":
            assert after.columns == docs.columns
        if name == "toxicity":
            bad = {i for i, _ in before if i < 300 and i % 5 == 0}
            assert len(bad - ids) >= 0.95 * len(bad) and len(before) - len(ids) <= len(bad) + 3
        if name == "exact_dedup":
            best = {}
            for i, t in before:
                best.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), i))
            assert ids == {min(m)[1] for m in best.values()}
        if name == "near_dedup":
            assert ids == {before[place][0] for place in brute_kept(before)}
        if name == "decontamination":
            assert ids == {r[0] for r in brute_contamination(before, [(1, item)]) if not r[5]}
        after.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(rows)
    expected = [
        (r["doc_id"], len(ids := library.encode_ordinary(texts[r["doc_id"]] or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
         hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest())
        for r in kept.collect()
    ]
    assert nulls_last(map(tuple, kept.collect())) == nulls_last(expected)
    assert nulls_last(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == nulls_last(expected)
