import re

import corpus_pipeline
import pytest
from matchlake.llm import mixing, pieces, queries
from matchlake.llm.common import documents, labels, partitions, stored
from pyspark.sql import functions as F

from .test_copies import sets_of

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "sentencepiece"]
    first = docs = documents(spark, SF)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        if name != "sentencepiece":
            assert docs.columns == first.columns
        out[name] = docs.collect()
    before = {r.doc_id: r for r in first.collect()}
    # toxicity: few clean documents go
    gone = set(before) - {r.doc_id for r in out["toxicity"]}
    toxic = {r.doc_id: r.toxic for r in labels(spark, SF).collect()}
    assert sum(toxic.get(i) == 0 for i in gone) <= 2
    # exact dedup: the smallest id of each text
    texts = {}
    for r in out["toxicity"]:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        texts[t] = min(r.doc_id, texts.get(t, r.doc_id))
    assert sorted(r.doc_id for r in out["exact_dedup"]) == sorted(texts.values())
    # near copies: no two left are linked, and each one gone is linked to its group
    left = [sets_of(r.text) for r in out["jaccard_join"]]
    for i, a in enumerate(left):
        assert not any(len(a & b) >= 0.8 * len(a | b) for b in left[:i] if a and b)
    ids = {r.doc_id for r in out["jaccard_join"]}
    all_ = [(r.doc_id, sets_of(r.text)) for r in out["exact_dedup"]]
    for i, a in all_:
        if i not in ids:
            assert any(j != i and len(a & b) >= 0.8 * len(a | b) for j, b in all_)
    # mixing: words per source as decided
    want = {}
    kept = stored(spark.createDataFrame(out["jaccard_join"], first.schema), "kept")
    for r in mixing.mix(kept).collect():
        want[r.source] = want.get(r.source, 0) + r.taken
    got = {}
    for r in out["mixing"]:
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert {k: v for k, v in want.items() if v} == {k: v for k, v in got.items() if v}
    # tokens: every text comes back
    c = pieces.Codec(pieces.read_vocabulary(pieces.default_model()))
    import numpy as np

    assert sorted(c.decode(np.array(r.ids)) for r in out["sentencepiece"]) == sorted(r.text for r in out["mixing"])


CLASHING = ["__k", "__n", "__digest", "__takes", "__copies", "__copy", "__toxic_score", "__toxic_votes", "th", "copies", "label", "cid"]


def test_stages_without_a_shuffle_have_as_many_partitions_as_files(spark):
    most = max(2 * spark.sparkContext.defaultParallelism, partitions(spark) // 8)
    many = documents(spark, SF).repartition(most + 9)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.encode):
        assert stage(spark, many, SF).rdd.getNumPartitions() <= most


def test_columns_of_any_name_pass_the_stages(spark, odd, some_labels):
    """Rows and values are those of the same table without such columns."""
    from matchlake.llm import exact_dedup, jaccard_join, toxicity

    names = CLASHING
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    clash = plain.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in names])
    stages = [exact_dedup.keep_first, jaccard_join.keep_one, mixing.mixed, lambda d: toxicity.drop_toxic(d, some_labels)]
    for stage in stages:
        got, want = stage(clash), stage(plain)
        assert got.columns == clash.columns
        rows = got.collect()
        assert sorted(map(str, (tuple(r)[:2] for r in rows))) == sorted(map(str, (tuple(r)[:2] for r in want.collect())))
        for r in rows:
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in names)


def test_names_differ_in_more_than_case(spark):
    from matchlake.llm.common import free_names

    df = spark.createDataFrame([], "__K int, ___k int, n int")
    assert free_names(df, "__k", "n", "m") == ["____k", "_n", "m"]
