import random

import corpus_pipeline as C
from pyspark.sql import functions as F

from tests.llm.test_containment import plain as plain_leaks
from tests.llm.test_mixing import plain as plain_mix
from tests.llm.test_near_duplicates import plain_components
from tests.llm.test_repair import reference


def corpus():
    rng = random.Random(12)
    parts = {"en": ["th", "er", "on", "an", "re", "ing"], "fr": ["é", "eau", "oi", "ç", "que"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(parts[lang], k=rng.randint(2, 5))) for _ in range(n))
    items = [(i, text("en", 20)) for i in range(5)]
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "en", "fr"])
        rows.append((i, text(lang, rng.randint(1, 80)), lang, f"src{i % 6}"))
    rows += [(200 + i, rows[i][1].upper() if i % 2 else rows[i][1] + " end", rows[i][2], "src0") for i in range(15)]
    rows += [(300 + i, "start " + t + " stop", "en", "src1") for i, t in items]
    # 73 of 73 + 15 shingles are shared: 0.83, a copy for this stage and none at 0.85
    long = text("en", 77)
    rows += [(420, long, "en", "src2"), (421, long + " " + text("en", 15), "en", "src3")]
    rows += [(400, None, "en", "src0"), (401, "12 34 56", "en", "src0")]
    return rows, items


def test_stages_and_run(spark, docs_of, tmp_path):
    rows, items = corpus()
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    by, now = {r[0]: r for r in rows}, docs
    want = [r[0] for r in rows if r[0] not in (400, 401)]
    for name, stage in C.STAGES[:4]:
        now = C.materialize(stage(spark, now, str(tmp_path)), name)
        assert now.columns == docs.columns
        if name == "near_dedup":
            comp = plain_components([by[i][:2] for i in want], 80)
            assert {420, 421} <= set(want) and comp[421] == 420 and plain_components([by[i][:2] for i in want])[421] == 421
            want = [i for i in want if comp[i] == i]
        if name == "decontaminate":
            leaks = {d for d, _ in plain_leaks([by[i][:2] for i in want], items)}
            assert leaks
            want = [i for i in want if i not in leaks]
        if name == "mix":
            want = [k[0] for k, v in plain_mix([by[i] for i in want]).items() for c in v for _ in range(c)]
        assert sorted(r.doc_id for r in now.collect()) == sorted(want), name
        assert now.join(docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t")), (F.col("doc_id") == F.col("d")) & F.col("text").eqNullSafe(F.col("t"))).count() == len(want)
    out = sorted(C.run(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    ids = reference([by[i][1] for i in sorted(want)])
    assert [(r.doc_id, r.n_tokens) for r in out] == [(i, len(x)) for i, x in zip(sorted(want), ids)]


def test_empty_documents(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= names and [n for n, _ in C.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "tokens"]
