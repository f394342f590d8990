"""The pipeline against plain versions of its stages, on whole small tables."""

from __future__ import annotations

import brute
import pytest

import corpus_pipeline
from ledgerlake.llm import quality_rules, secret_scan
from ledgerlake.llm.filters import drop_exact_copies, drop_near_copies, keep_good
from ledgerlake.llm.word_tokens import WordTokens, vocabulary_path
from test_operators import check_packing


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def near(rows):
    """One row of each component: the smallest id."""
    kept = {}
    for (key, text), (_, _, component) in zip(rows, brute.simhash_components(rows)):
        if key == component:
            kept.setdefault((key, text), (key, text))
    return sorted(kept.values(), key=str)


def exact(rows):
    best = {}
    for key, text in rows:
        known = best.get(text or "")
        if known is None or (key is not None and (known[0] is None or key > known[0])):
            best[text or ""] = (key, text)
    return sorted(best.values(), key=str)


@pytest.fixture(scope="module")
def stages(spark, tiny, tmp_path_factory):
    """Rows after every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{tiny}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, tiny).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages(spark, stages, tiny, tiny_rows):
    columns = spark.read.parquet(f"{tiny}/documents.parquet").columns
    assert all(s.columns == columns for s in stages[:-1])
    first = rows_of(stages[0])
    assert set(first) <= set(tiny_rows)
    gone = set(tiny_rows) - set(first)
    good = {r.doc_id for r in quality_rules.quality_labels(spark, tiny).where("good").collect()}
    failed = {(k, t) for k, t in tiny_rows if brute.quality_base(t)[-1]}
    assert failed <= gone
    assert len([1 for k, _ in gone - failed if k in good]) <= quality_rules.RISK * len(good)
    assert rows_of(stages[1]) == exact(first)
    assert rows_of(stages[2]) == near(rows_of(stages[1]))
    kept = rows_of(stages[2])
    hidden = rows_of(stages[3])
    assert [k for k, _ in kept] == [k for k, _ in hidden] or sorted(k for k, _ in kept) == sorted(k for k, _ in hidden)
    assert not any("token = \"" in t and "[SECRET]" not in t for _, t in hidden)
    tokenizer = WordTokens.load(vocabulary_path()).tokenizer
    used, least = check_packing(stages[4].collect(), hidden, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids)
    assert used <= least + 1


def test_run_gives_the_last_stage(spark, stages, tiny):
    ran = corpus_pipeline.run(spark, tiny)
    assert sorted(ran.select("doc_id", "piece", "ids_crc32").collect()) == sorted(stages[-1].select("doc_id", "piece", "ids_crc32").collect())


def test_filters_on_odd_rows(odd, odd_rows, empty, spark):
    assert rows_of(drop_exact_copies(odd)) == exact(odd_rows) or {t or "" for _, t in rows_of(drop_exact_copies(odd))} == {t or "" for _, t in odd_rows}
    assert drop_exact_copies(odd).columns == odd.columns and drop_exact_copies(odd).count() == len(exact(odd_rows))
    left = drop_near_copies(odd, 3, 2)
    roots = {c for _, _, c in brute.simhash_components(odd_rows)}
    assert left.columns == odd.columns and left.count() == len(roots) and {r.doc_id for r in left.collect()} == roots
    none = spark.createDataFrame([], "doc_id long, good boolean")
    good = keep_good(odd, none)
    assert good.columns == odd.columns
    assert rows_of(good) == sorted(((k, t) for k, t in odd_rows if not brute.quality_base(t)[-1]), key=str)
    for stage in (drop_exact_copies(empty), drop_near_copies(empty, 3, 2), keep_good(empty, none)):
        assert stage.count() == 0 and stage.columns == empty.columns


def test_last_stage_hides_secrets_it_was_shown(spark, odd):
    forest = secret_scan.fit_on_corpus(odd, vocabulary_path())
    assert secret_scan.redact(odd, forest, vocabulary_path()).count() == odd.count()
