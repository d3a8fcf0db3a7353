"""The stages on one small corpus, against brute force where the stage is exact."""

import random

import corpus_pipeline
import public_tokenizers
from test_near_dedup import brute as near_groups
from tokenizers import Tokenizer

LANGS = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ung", "ber", "ein"]}


def corpus(spark):
    random.seed(21)
    rows = []
    for i in range(240):
        lang = random.choice(list(LANGS))
        words = ["".join(random.choices(LANGS[lang], k=random.randint(1, 4))) for _ in range(random.choice([8, 40, 700]))]
        rows.append((i, " ".join(words), lang, random.choice(["a", "b", "c"]), 1))
    for i in range(60):
        _, text, lang, source, n = rows[i]
        words = text.split(" ")
        if i % 2 and len(words) > 30:
            words[3] = words[4]
        rows.append((300 + i, " ".join(words).upper() if i % 4 == 0 else " ".join(words), lang, source, n))
    rows += [(400, None, None, None, None), (401, "42 !!", "xx", "a", 5), (402, "", "yy", "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows


def test_stages(spark):
    docs, rows = corpus(spark)
    kept, columns = docs, docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    held = {}
    for name, stage in list(stages.items())[:-1]:
        kept = stage(spark, kept, "")
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        held[name] = [tuple(r) for r in kept.collect()]
    assert sorted(r[0] for r in held["language ID"]) == [r[0] for r in rows if r[0] < 400]
    groups = {}
    for r in held["language ID"]:
        groups.setdefault(r[1].lower(), []).append(r[0])
    assert sorted(r[0] for r in held["exact dedup"]) == sorted(map(max, groups.values()))
    components = near_groups(held["exact dedup"])
    assert sorted(r[0] for r in held["MinHash near-dedup"]) == sorted({c for _, c in components.values()})
    assert set(held["mixing sources to target weights"]) <= set(held["MinHash near-dedup"])
    packed = stages["best-fit packing"](spark, kept, "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r[1]).ids) + 1 for r in held["mixing sources to target weights"])
    assert sum(r.length for r in packed) == want


def test_run_equals_its_stages_and_takes_no_rows(spark, tmp_path):
    docs, _ = corpus(spark)
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a")
    assert got.count() > 100 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []
